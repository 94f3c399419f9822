"""DuckDB statements equal to the registered Spark queries.

They are written straight from the formulas (dense sums over every query
term for the language models, explicit row_number ranks), independent of
the decompositions the Spark side uses, so a match checks both.

Tables available as views: documents, benchmark, labels, pages, embeddings.
"""

from __future__ import annotations

from quarry.functions import text as T
from quarry.operators import boundaries as B


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = _lit(T.WS_SPLIT)
BLANK_FROM = _lit(T.INDEX_BLANK_CHARS)
BLANK_TO = _lit(" " * len(T.INDEX_BLANK_CHARS))
STOPS = ", ".join(_lit(w) for w in T.STOP_WORDS)


def ws(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), {WS}), lambda t: t <> '')"


def idx(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(translate(lower(coalesce({x}, '')), {BLANK_FROM}, {BLANK_TO}), {WS}),"
            f" lambda t: t <> '')")


def wc(x: str) -> str:
    return f"len(string_split(coalesce({x}, 'nan'), ' '))"


def html_text(x: str) -> str:
    t = f"regexp_replace({x}, {_lit(T.HTML_COMMENT)}, '', 'g')"
    t = f"regexp_replace({t}, {_lit(T.HTML_SCRIPT_STYLE)}, '', 'g')"
    t = f"regexp_replace({t}, {_lit(T.HTML_TAG)}, '', 'g')"
    return f"regexp_replace({t}, {_lit(T.HTML_ENTITY)}, ' ', 'g')"


def words_plain(x: str) -> str:
    text = html_text(f"coalesce({x}, '')")
    return (f"list_filter(regexp_split_to_array(lower(regexp_replace({text}, '[^a-zA-Z]', ' ', 'g')), {WS}),"
            f" lambda t: t <> '')")


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


P = "P AS (SELECT doc_id AS pid, text AS passage, doc_id AS ord FROM documents)"
Q = "Q AS (SELECT item_id AS qid, text AS query FROM benchmark)"
# Query terms with counts, query lengths.
QT = (f"QT AS (SELECT qid, ql, term, count(*)::BIGINT AS k FROM ("
      f"SELECT qid, len(toks) AS ql, unnest(toks) AS term FROM (SELECT qid, {ws('query')} AS toks FROM Q)) "
      f"GROUP BY qid, ql, term)")
QL = f"QL AS (SELECT qid, len({ws('query')}) AS ql FROM Q)"
# Full inverted index and document frequencies.
POST = (f"POST AS (SELECT term, pid, count(*)::BIGINT AS tf, wc AS word_count FROM ("
        f"SELECT pid, {wc('passage')} AS wc, unnest({idx('passage')}) AS term FROM P) GROUP BY term, pid, wc)")
DF = "DF AS (SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM POST GROUP BY term)"
# Raw whitespace term counts per passage, passage lengths.
RT = (f"RT AS (SELECT pid, term, count(*)::BIGINT AS f FROM ("
      f"SELECT pid, unnest({ws('passage')}) AS term FROM P) GROUP BY pid, term)")
PL_ = f"PLEN AS (SELECT pid, ord, len({ws('passage')}) AS dl, {wc('passage')} AS wc FROM P)"
STATS = ("ST AS (SELECT (SELECT count(*) FROM P) AS n, (SELECT avg(wc) FROM PLEN) AS avdl, "
         "(SELECT sum(wc) FROM PLEN) AS pl, (SELECT count(DISTINCT pid) FROM POST) AS n1, "
         "(SELECT count(*) FROM DF) AS v)")
CAND = ("CAND AS (SELECT DISTINCT qt.qid, p.pid, pp.ord FROM POST p JOIN QT qt ON p.term = qt.term "
        "JOIN P pp ON pp.pid = p.pid)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (P, Q, QT, QL, POST, DF, RT, PL_, STATS, CAND)

# Per-(pair, distinct query term) rows with f (0 when absent): the dense form.
PAIRTERM = ("PT AS (SELECT c.qid, c.pid, c.ord, qt.term, qt.k, qt.ql, pl.dl, coalesce(rt.f, 0) AS f, df.df, df.cf "
            "FROM CAND c JOIN QT qt ON qt.qid = c.qid JOIN PLEN pl ON pl.pid = c.pid "
            "LEFT JOIN RT rt ON rt.pid = c.pid AND rt.term = qt.term LEFT JOIN DF df ON df.term = qt.term)")

BM25 = ("BM AS (SELECT qid, pid, ord, coalesce(sum(CASE WHEN df IS NOT NULL THEN k * ln((st.n - df + 0.5) / (df + 0.5)) "
        "* (f * 2.2 / (1.2 * (0.25 + 0.75 * dl / st.avdl) + f)) * (k * 101.0 / (100 + k)) END), 0) AS score "
        "FROM PT, ST st GROUP BY qid, pid, ord)")
LAPLACE = ("LA AS (SELECT qid, pid, ord, sum(k * ln((f + 1.0) / (dl + st.v))) AS score FROM PT, ST st "
           "GROUP BY qid, pid, ord)")
LIDSTONE = ("LI AS (SELECT qid, pid, ord, sum(k * ln((CASE WHEN dl = 0 THEN 0.0 ELSE f / dl END + 0.1) "
            "/ (dl + 0.1 * st.v))) AS score FROM PT, ST st GROUP BY qid, pid, ord)")
DIRICHLET = ("DI AS (SELECT qid, pid, ord, coalesce(sum(CASE WHEN df IS NOT NULL THEN k * ln(f / (dl + 50.0) "
             "+ 50.0 * df / (st.pl * (dl + 50.0))) END), 0) AS score FROM PT, ST st GROUP BY qid, pid, ord)")
QVEC = ("QV AS (SELECT qt.qid, qt.term, qt.k, (qt.k * 1.0 / qt.ql) * log10(st.n1 / df.df) AS weight "
        "FROM QT qt JOIN DF df USING (term), ST st)")
PVEC = ("PV AS (SELECT p.pid, p.term, (p.tf * 1.0 / p.word_count) * log10(st.n / df.df) AS weight "
        "FROM POST p JOIN DF df USING (term), ST st)")
COSINE = ("CO AS (SELECT c.qid, c.pid, c.ord, CASE WHEN coalesce(qn.qnorm * pn.pnorm, 0) = 0 THEN 0.0 "
          "ELSE coalesce(d.dot, 0) / (qn.qnorm * pn.pnorm) END AS score FROM CAND c "
          "LEFT JOIN (SELECT qv.qid, pv.pid, sum(qv.k * qv.weight * pv.weight) AS dot FROM QV qv JOIN PV pv USING (term) "
          "GROUP BY qv.qid, pv.pid) d ON d.qid = c.qid AND d.pid = c.pid "
          "LEFT JOIN (SELECT qid, sqrt(sum(k * weight * weight)) AS qnorm FROM QV GROUP BY qid) qn ON qn.qid = c.qid "
          "LEFT JOIN (SELECT pid, sqrt(sum(weight * weight)) AS pnorm FROM PV GROUP BY pid) pn ON pn.pid = c.pid)")

SCORER_CTE = {"bm25": ("BM", (PAIRTERM, BM25)), "laplace": ("LA", (PAIRTERM, LAPLACE)),
              "lidstone": ("LI", (PAIRTERM, LIDSTONE)), "dirichlet": ("DI", (PAIRTERM, DIRICHLET)),
              "tfidf_cosine": ("CO", (QVEC, PVEC, COSINE))}


def scored(name: str) -> str:
    alias, ctes = SCORER_CTE[name]
    return with_(*BASE, *ctes) + f"SELECT qid, pid, {r6('score')} AS score FROM {alias}"


def prefix_ranked(name: str, k: int = 100) -> tuple[str, str]:
    """CTEs scoring only the first k candidates per query (by ord), then ranking by score."""
    alias, ctes = SCORER_CTE[name]
    return alias, (f"R_{alias} AS (SELECT s.qid, s.pid, s.score, row_number() OVER (PARTITION BY s.qid "
                   f"ORDER BY round(s.score, 9) DESC, s.ord) AS rank FROM {alias} s "
                   f"JOIN (SELECT qid, ord FROM (SELECT qid, ord, row_number() OVER "
                   f"(PARTITION BY qid ORDER BY ord) AS rn FROM CAND) WHERE rn <= {k}) pre "
                   f"ON pre.qid = s.qid AND pre.ord = s.ord)")


def run_union() -> str:
    ctes, parts = [], []
    seen = set()
    for name in ("tfidf_cosine", "bm25", "laplace", "lidstone", "dirichlet"):
        alias, scorer_ctes = SCORER_CTE[name]
        for c in scorer_ctes:
            if c not in seen:
                seen.add(c)
                ctes.append(c)
        ctes.append(f"R_{alias} AS (SELECT qid, pid, score, row_number() OVER (PARTITION BY qid "
                    f"ORDER BY round(score, 9) DESC, ord) AS rank FROM {alias})")
        parts.append(f"SELECT '{name}' AS algoname, qid, pid, {r6('score')} AS score, rank FROM R_{alias}")
    return with_(*BASE, *ctes) + " UNION ALL ".join(parts)


def bm25_prefix100() -> str:
    _, rk = prefix_ranked("bm25")
    return with_(*BASE, PAIRTERM, BM25, rk) + f"SELECT qid, pid, {r6('score')} AS score, rank FROM R_BM"


LAB = ("LAB AS (SELECT c.qid, c.pid, c.ord, "
       "(CASE WHEN contains(lower(coalesce(p.passage, '')), lower(coalesce(q.query, ''))) THEN 1.0 ELSE 0.0 END)::DOUBLE AS relevancy, "
       "(CASE WHEN contains(lower(coalesce(p.passage, '')), lower(coalesce(q.query, ''))) THEN 2.0 "
       "WHEN g.pid IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS grade "
       "FROM CAND c JOIN P p ON p.pid = c.pid JOIN Q q ON q.qid = c.qid "
       "LEFT JOIN (SELECT DISTINCT doc_id AS pid FROM labels WHERE quality = 1 AND toxic = 0) g ON g.pid = c.pid)")


def labelled(name: str) -> tuple[str, ...]:
    """CTEs ending in RUN_<alias>: every candidate scored, labelled and ranked."""
    alias, ctes = SCORER_CTE[name]
    run = (f"RUN_{alias} AS (SELECT s.qid, s.pid, s.ord, s.score, l.relevancy, l.grade, "
           f"row_number() OVER (PARTITION BY s.qid ORDER BY round(s.score, 9) DESC, s.ord) AS rank "
           f"FROM {alias} s JOIN LAB l ON l.qid = s.qid AND l.pid = s.pid AND l.ord = s.ord)")
    return (*ctes, LAB, run)


def ap_cte(alias: str) -> str:
    return (f"AP_{alias} AS (SELECT r.qid, coalesce(a.ap, 0.0) AS ave_precision FROM (SELECT DISTINCT qid FROM RUN_{alias}) r "
            f"LEFT JOIN (SELECT qid, sum(hit_no * 1.0 / rank) / count(*) AS ap FROM (SELECT qid, rank, "
            f"row_number() OVER (PARTITION BY qid ORDER BY rank) AS hit_no FROM RUN_{alias} WHERE relevancy = 1.0) "
            f"GROUP BY qid) a ON a.qid = r.qid)")


def dcg_cte(alias: str) -> str:
    return (f"DCG_{alias} AS (SELECT r.qid, coalesce(d.dcg, 0.0) AS dcg FROM (SELECT DISTINCT qid FROM RUN_{alias}) r "
            f"LEFT JOIN (SELECT qid, sum((pow(2.0, grade) - 1.0) / log2(rank + 1.0)) AS dcg FROM RUN_{alias} "
            f"WHERE grade > 0 GROUP BY qid) d ON d.qid = r.qid)")


def ndcg_global_cte(alias: str) -> str:
    return (f"NG_{alias} AS (SELECT qid, dcg, CASE WHEN max(dcg) OVER () = 0 THEN 0.0 "
            f"ELSE dcg / max(dcg) OVER () END AS ndcg FROM DCG_{alias})")


def ndcg_ideal_cte(alias: str) -> str:
    return (f"NI_{alias} AS (SELECT d.qid, d.dcg, CASE WHEN coalesce(i.idcg, 0) = 0 THEN 0.0 ELSE d.dcg / i.idcg END AS ndcg "
            f"FROM DCG_{alias} d LEFT JOIN (SELECT qid, sum((pow(2.0, grade) - 1.0) / log2(irank + 1.0)) AS idcg FROM ("
            f"SELECT qid, grade, row_number() OVER (PARTITION BY qid ORDER BY grade DESC, ord) AS irank "
            f"FROM RUN_{alias} WHERE grade > 0) GROUP BY qid) i ON i.qid = d.qid)")


def summary_sql() -> str:
    ctes, parts, seen = [], [], set()
    for name in ("tfidf_cosine", "bm25", "laplace", "lidstone", "dirichlet"):
        alias = SCORER_CTE[name][0]
        for c in (*labelled(name), ap_cte(alias), dcg_cte(alias), ndcg_global_cte(alias)):
            if c not in seen:
                seen.add(c)
                ctes.append(c)
        parts.append(f"SELECT '{name}' AS algoname, {r6('avg(a.ave_precision)')} AS map, "
                     f"{r6('avg(n.ndcg)')} AS mean_ndcg FROM AP_{alias} a JOIN NG_{alias} n ON n.qid = a.qid")
    return with_(*BASE, *ctes) + " UNION ALL ".join(parts)


def avg_word_vectors_sql() -> str:
    voc = ("VOC AS (SELECT term AS word, vec_id FROM (SELECT term, (row_number() OVER (ORDER BY cf DESC, term) - 1) "
           "% (SELECT count(*) FROM embeddings) AS vec_id FROM DF))")
    vec = "VEC AS (SELECT v.word, e.embedding FROM VOC v JOIN embeddings e ON e.vec_id = v.vec_id)"
    txt = (f"TXT AS (SELECT 'q' AS kind, qid AS id, {words_plain('query')} AS w FROM Q UNION ALL "
           f"SELECT 'p' AS kind, pid AS id, list_filter({words_plain('passage')}, lambda t: t NOT IN ({STOPS})) AS w FROM P)")
    w = "W AS (SELECT kind, id, unnest(w) AS word FROM TXT)"
    avgs = ("AVGS AS (SELECT kind, id, dim, avg(val) AS value FROM (SELECT h.kind, h.id, unnest(range(len(h.embedding))) AS dim, "
            "unnest(h.embedding)::DOUBLE AS val FROM (SELECT w.kind, w.id, e.embedding FROM W w JOIN VEC e ON e.word = w.word) h) "
            "GROUP BY kind, id, dim)")
    alld = "ALLD AS (SELECT t.kind, t.id, d.dim FROM TXT t, range(64) d(dim))"
    return with_(P, Q, POST, DF, voc, vec, txt, w, avgs, alld) + (
        "SELECT a.kind, a.id, a.dim::BIGINT AS dim, " + r6("coalesce(v.value, 0.0)") + " AS value "
        "FROM ALLD a LEFT JOIN AVGS v ON v.kind = a.kind AND v.id = a.id AND v.dim = a.dim")


LABELLED_BASE = (*BASE, LAB)


# Word types of the corpus with and without a final period, and their scores as abbreviations.
OPENING, CLOSING = _lit(B.OPENING), _lit(B.CLOSING)


def token_type(x: str) -> str:
    return f"lower(rtrim(ltrim({x}, {OPENING}), {CLOSING}))"


ABBREVIATIONS = (
    f"TOK AS (SELECT {token_type('tok')} AS t FROM (SELECT unnest({ws('text')}) AS tok FROM documents))",
    "TYP AS (SELECT CASE WHEN ends THEN rtrim(t, '.') ELSE t END AS type, ends FROM (SELECT t, ends_with(t, '.') AS ends FROM TOK))",
    "CNT AS (SELECT type, count(*) FILTER (ends) AS k, count(*) FILTER (NOT ends) AS m FROM TYP "
    "WHERE regexp_matches(type, '[a-zA-Z]') OR lower(type) <> upper(type) GROUP BY type)",
    "SHR AS (SELECT sum(k) / sum(k + m) AS p FROM CNT)",
    "SCO AS (SELECT type, k, m, -2 * (k * ln(p) + m * ln(1 - p) - k * ln(0.99) - m * ln(1 - 0.99)) AS llr, "
    "length(replace(type, '.', ''))::DOUBLE AS len, length(type) - length(replace(type, '.', '')) AS inner_, p FROM CNT, SHR)",
    "ABB AS (SELECT type, k, m, llr, CASE WHEN k > 0 THEN llr * exp(-len) * (inner_ + 1) * pow(len, -m) ELSE 0.0 END AS score FROM SCO)",
)
LEARNED_SENTENCES = with_(
    *ABBREVIATIONS,
    f"PC AS (SELECT pid, unnest(range(len(s))) AS place, unnest(s) AS piece FROM (SELECT doc_id AS pid, list_filter(string_split("
    f"regexp_replace(regexp_replace(coalesce(text, ''), {_lit(T.EDGE_WS)}, '', 'g'), {_lit(T.SENTENCE_BREAK)}, '\\1' || chr(1), 'g'), chr(1)), "
    f"lambda t: t <> '') AS s FROM documents))",
    f"LW AS (SELECT *, {token_type(chr(39).join(['regexp_extract(piece, ', '(' + chr(92) + 'S+)' + chr(92) + 's*$', ', 1)']))} AS t FROM PC)",
    "GO AS (SELECT pid, place, piece, ends_with(t, '.') AND (rtrim(t, '.') IN (SELECT type FROM ABB WHERE score >= 0.3) "
    "OR (length(rtrim(t, '.')) = 1 AND lower(rtrim(t, '.')) <> upper(rtrim(t, '.')))) AS goes FROM LW)",
    "GR AS (SELECT *, coalesce(sum(CASE WHEN goes THEN 0 ELSE 1 END) OVER (PARTITION BY pid ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM GO)",
    "SE AS (SELECT pid, g, string_agg(piece, ' ' ORDER BY place) AS s FROM GR GROUP BY pid, g)",
) + ("SELECT d.doc_id AS pid, count(s.s) AS n_sentences, md5(coalesce(string_agg(s.s, chr(10) ORDER BY s.g), '')) AS md5 "
     "FROM documents d LEFT JOIN SE s ON s.pid = d.doc_id GROUP BY d.doc_id")


# Averaged fixture vectors of both texts of every labelled pair, one list a pair.
def pair_vectors(dim: int = 64) -> tuple[str, ...]:
    voc = ("VOC AS (SELECT term AS word, vec_id FROM (SELECT term, (row_number() OVER (ORDER BY cf DESC, term) - 1) "
           "% (SELECT count(*) FROM embeddings) AS vec_id FROM DF))")
    txt = (f"TXT AS (SELECT 'q' AS kind, qid AS id, {words_plain('query')} AS w FROM Q UNION ALL "
           f"SELECT 'p' AS kind, pid AS id, list_filter({words_plain('passage')}, lambda t: t NOT IN ({STOPS})) AS w FROM P)")
    avgs = ("AVGS AS (SELECT kind, id, list(value ORDER BY dim) AS v FROM (SELECT kind, id, dim, avg(val) AS value FROM ("
            "SELECT w.kind, w.id, unnest(range(len(e.embedding))) AS dim, unnest(e.embedding)::DOUBLE AS val FROM "
            "(SELECT kind, id, unnest(w) AS word FROM TXT) w JOIN VOC o ON o.word = w.word JOIN embeddings e ON e.vec_id = o.vec_id) "
            "GROUP BY kind, id, dim) GROUP BY kind, id)")
    zero = "list_transform(range(%d), lambda i: 0.0::DOUBLE)" % dim
    px = (f"PX AS MATERIALIZED (SELECT l.qid, l.pid, l.relevancy AS y, coalesce(q.v, {zero}) || coalesce(p.v, {zero}) AS x FROM LAB l "
          "LEFT JOIN AVGS q ON q.kind = 'q' AND q.id = l.qid LEFT JOIN AVGS p ON p.kind = 'p' AND p.id = l.pid)")
    return voc, txt, avgs, px


def factorised_descent_sql(rates=(0.5, 5.0), iterations: int = 10, dim: int = 128) -> str:
    """Dense gradient descent over the concatenated features, one CTE an iteration."""
    steps, out = ["N AS (SELECT count(*)::DOUBLE AS m FROM PX)"], []
    for k, rate in enumerate(rates):
        steps.append(f"S{k}_0 AS (SELECT list_transform(range({dim}), lambda i: 0.0::DOUBLE) AS w, 0.0::DOUBLE AS b)")
        for i in range(iterations):
            z = "list_dot_product(PX.x, s.w) + s.b"
            steps.append(f"E{k}_{i} AS MATERIALIZED (SELECT x, y, z, 1.0 / (1.0 + exp(-z)) - y AS e FROM (SELECT PX.x, PX.y, {z} AS z FROM PX, S{k}_{i} s))")
            steps.append(f"G{k}_{i} AS (SELECT list(g ORDER BY j) AS g FROM (SELECT j, sum(e * v) AS g FROM ("
                         f"SELECT e, unnest(x) AS v, unnest(range({dim})) AS j FROM E{k}_{i}) GROUP BY j))")
            steps.append(f"S{k}_{i + 1} AS MATERIALIZED (SELECT list_transform(range({dim}), lambda j: s.w[j + 1] - {rate} * g.g[j + 1] / N.m) AS w, "
                         f"s.b - {rate} * (SELECT sum(e) FROM E{k}_{i}) / N.m AS b FROM S{k}_{i} s, G{k}_{i} g, N)")
            cost = "avg(greatest(z, 0) + ln(1 + exp(-abs(z))) - y * z)"
            out.append(f"SELECT {rate}::DOUBLE AS rate, 'cost{i}' AS param, {r6(cost)} AS value FROM E{k}_{i}")
        last = f"S{k}_{iterations}"
        out.append(f"SELECT {rate}::DOUBLE, 'w' || j, {r6('v')} FROM (SELECT unnest(w) AS v, unnest(range({dim})) AS j FROM {last})")
        out.append(f"SELECT {rate}::DOUBLE, 'b', {r6('b')} FROM {last}")
    return with_(*LABELLED_BASE, *pair_vectors(), *steps) + " UNION ALL ".join(out)


def factorised_predict_sql(dim: int = 128) -> str:
    w = f"list_transform(range({dim}), lambda i: ((i * 7) % 11 - 5) / 10.0)"
    z = f"(list_dot_product(x, {w}::DOUBLE[]) + 0.05)"
    return with_(*LABELLED_BASE, *pair_vectors()) + (
        f"SELECT qid, pid, {r6('p')} AS probability, (CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END)::DOUBLE AS prediction "
        f"FROM (SELECT qid, pid, 1.0 / (1.0 + exp(-{z})) AS p FROM PX)")


LOGISTIC_STEP = with_(
    "X AS (SELECT vec_id, y, unnest(range(len(embedding))) AS j, unnest(embedding)::DOUBLE AS x FROM "
    "(SELECT vec_id, embedding, (CASE WHEN label >= 5 THEN 1.0 ELSE 0.0 END)::DOUBLE AS y FROM embeddings))",
    "R AS (SELECT DISTINCT vec_id, y FROM X)",
    "M AS (SELECT count(*)::DOUBLE AS m FROM R)",
    "W1 AS (SELECT j, -0.1 * sum((0.5 - y) * x) / (SELECT m FROM M) AS w FROM X GROUP BY j)",
    "B1 AS (SELECT -0.1 * sum(0.5 - y) / (SELECT m FROM M) AS b FROM R)",
    "Z AS (SELECT X.vec_id, X.y, sum(X.x * W1.w) + (SELECT b FROM B1) AS z FROM X JOIN W1 ON W1.j = X.j "
    "GROUP BY X.vec_id, X.y)",
    "PZ AS (SELECT vec_id, y, z, 1.0 / (1.0 + exp(-z)) AS p FROM Z)",
    "W2 AS (SELECT W1.j, W1.w - 0.1 * sum((PZ.p - PZ.y) * X.x) / (SELECT m FROM M) AS w FROM X "
    "JOIN PZ ON PZ.vec_id = X.vec_id JOIN W1 ON W1.j = X.j GROUP BY W1.j, W1.w)",
    "B2 AS (SELECT (SELECT b FROM B1) - 0.1 * sum(p - y) / (SELECT m FROM M) AS b FROM PZ)",
    "C AS (SELECT ln(2.0) AS cost0, avg(y * (greatest(-z, 0) + ln(1 + exp(-abs(z)))) "
    "+ (1 - y) * (greatest(z, 0) + ln(1 + exp(-abs(z))))) AS cost1 FROM PZ)",
) + (f"SELECT 'w' || j AS param, {r6('w')} AS value FROM W2 UNION ALL SELECT 'b', {r6('b')} FROM B2 "
     f"UNION ALL SELECT 'cost0', {r6('cost0')} FROM C UNION ALL SELECT 'cost1', {r6('cost1')} FROM C")

LOGISTIC_PREDICT = (
    f"SELECT vec_id, {r6('z')} AS z, {r6('1.0 / (1.0 + exp(-z))')} AS probability, "
    f"(CASE WHEN 1.0 / (1.0 + exp(-z)) > 0.5 THEN 1.0 ELSE 0.0 END)::DOUBLE AS prediction FROM ("
    f"SELECT x.vec_id, sum(x.e * w.w) + 0.05 AS z FROM (SELECT vec_id, unnest(range(len(embedding))) AS i, "
    f"unnest(embedding)::DOUBLE AS e FROM embeddings) x JOIN (SELECT i, ((i * 7) % 11 - 5) / 10.0 AS w "
    f"FROM range(64) t(i)) w ON w.i = x.i GROUP BY x.vec_id)")

LIBSVM_ROUNDTRIP = (
    f"SELECT qid, label, dim, {r6('value')} AS value FROM (SELECT vec_id % 25 AS qid, label::DOUBLE AS label, "
    f"unnest(range(len(embedding)))::BIGINT AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings)")


# The candidate file: every passage under the queries pid and pid + 1 (modulo their
# number), tabs and line ends of all texts as blanks.
FLAT = "translate({0}, chr(9) || chr(10) || chr(13), '   ')"
FILE_P = f"P AS (SELECT doc_id AS pid, coalesce({FLAT.format('text')}, '') AS passage, doc_id AS ord FROM documents)"
FILE_Q = f"Q AS (SELECT item_id AS qid, {FLAT.format('text')} AS query FROM benchmark)"
FILE_CAND = ("CAND AS (SELECT q.qid, p.pid, p.ord FROM P p, (VALUES (0), (1)) t(k) JOIN Q q "
             "ON q.qid = (p.pid + t.k) % (SELECT count(*) FROM Q))")
FILE_BASE = (FILE_P, FILE_Q, QT, QL, POST, DF, RT, PL_, STATS, FILE_CAND)

# Gradients straight from the row pairs of each query.
PAIRS = ("PR AS (SELECT a.qid, a.pid AS hi, b.pid AS lo, 1.0 / (1.0 + exp(b.score - a.score)) AS p FROM RUN_BM a "
         "JOIN RUN_BM b ON a.qid = b.qid AND a.relevancy > b.relevancy)")
GRADIENTS = ("GR AS (SELECT qid, pid, sum(g) AS g, sum(h) AS h FROM ("
             "SELECT qid, hi AS pid, p - 1 AS g, greatest(2 * p * (1 - p), 1e-16) AS h FROM PR "
             "UNION ALL SELECT qid, lo, 1 - p, greatest(2 * p * (1 - p), 1e-16) FROM PR) GROUP BY qid, pid)")


ORACLE: dict[str, str] = {
    "passage_dedup_pid": with_(FILE_P) + f"SELECT pid, {wc('passage')}::BIGINT AS word_count, md5(passage) AS passage_md5 FROM P",
    "labelled_tsv": with_(FILE_P, FILE_Q, FILE_CAND) + (
        "SELECT c.qid, c.pid, md5(q.query) AS query_md5, md5(p.passage) AS passage_md5, "
        "(CASE WHEN contains(lower(coalesce(d.text, '')), lower(b.text)) THEN 1.0 ELSE 0.0 END)::DOUBLE AS relevancy "
        "FROM CAND c JOIN P p USING (pid) JOIN Q q USING (qid) JOIN documents d ON d.doc_id = c.pid "
        "JOIN benchmark b ON b.item_id = c.qid"),
    "tsv_bm25_run": with_(*FILE_BASE, PAIRTERM, BM25) + f"SELECT qid, pid, {r6('score')} AS score FROM BM",
    "corpus_terms": with_(P, POST, DF) + "SELECT term, cf AS count FROM DF",
    "matrix_roundtrip": (
        f"SELECT row, dim, {r6('value')} AS value FROM (SELECT row_number() OVER (ORDER BY vec_id) AS row, "
        f"unnest(range(len(embedding)))::BIGINT AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings)"),
    "pairwise_gradients": with_(*BASE, *labelled("bm25"), PAIRS, GRADIENTS) + (
        f"SELECT r.qid, r.pid, {r6('coalesce(g.g, 0)')} AS gradient, {r6('coalesce(g.h, 0)')} AS hessian "
        f"FROM RUN_BM r LEFT JOIN GR g USING (qid, pid)"),
    "tokenize_index": f"SELECT doc_id AS pid, len({idx('text')})::BIGINT AS n_tokens, "
                      f"array_to_string({idx('text')}, ' ') AS tokens FROM documents",
    "tokenize_ws": f"SELECT item_id AS qid, len({ws('text')})::BIGINT AS n_tokens, "
                   f"array_to_string({ws('text')}, ' ') AS tokens FROM benchmark",
    "wordlist_html": f"SELECT page_id, len(w)::BIGINT AS n_words, array_to_string(w, ' ') AS words "
                     f"FROM (SELECT page_id, {words_plain('html')} AS w FROM pages)",
    "wordlist_stopwords": f"SELECT page_id, len(w)::BIGINT AS n_words, array_to_string(w, ' ') AS words "
                          f"FROM (SELECT page_id, list_filter({words_plain('html')}, lambda t: t NOT IN ({STOPS})) AS w "
                          f"FROM pages)",
    "sentences": (
        f"SELECT pid, sent_no, len(w)::BIGINT AS n_words, array_to_string(w, ' ') AS words FROM ("
        f"SELECT pid, sent_no, {words_plain('sentence')} AS w FROM ("
        f"SELECT pid, unnest(range(len(s)))::BIGINT AS sent_no, unnest(s) AS sentence FROM ("
        f"SELECT doc_id AS pid, list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''), "
        f"{_lit(T.EDGE_WS)}, '', 'g'), {_lit(T.SENTENCE_BREAK)}, '\\1' || chr(1), 'g'), chr(1)), lambda t: t <> '') AS s "
        f"FROM documents)))"),
    "abbreviation_scores": with_(*ABBREVIATIONS) + (
        f"SELECT type, k::BIGINT AS with_period, m::BIGINT AS without, {r6('llr')} AS llr, {r6('score')} AS score FROM ABB"),
    "learned_sentences": LEARNED_SENTENCES,
    "file_prefix": f"SELECT doc_id AS pid, md5({FLAT.format('coalesce(text, ' + chr(39) * 2 + ')')}) AS passage_md5 FROM documents ORDER BY doc_id LIMIT 400",
    "passage_dedup": f"SELECT min(doc_id) AS pid, arg_min({wc('text')}, doc_id)::BIGINT AS word_count, "
                     f"count(*)::BIGINT AS n_copies FROM documents GROUP BY coalesce(text, '')",
    "vocabulary": with_(P, POST) + (
        "SELECT term, count, " + r6("count * 1.0 / sum(count) OVER ()") + " AS normalised_frequency, "
        "row_number() OVER (ORDER BY count DESC, term) AS rank FROM (SELECT term, sum(tf)::BIGINT AS count "
        "FROM POST GROUP BY term)"),
    "zipf": with_(P, POST) + (
        "SELECT rank, term, " + r6("nf") + " AS normalised_frequency, " + r6("1.0 / (rank * hn)") + " AS zipf FROM ("
        "SELECT term, count * 1.0 / sum(count) OVER () AS nf, row_number() OVER (ORDER BY count DESC, term) AS rank "
        "FROM (SELECT term, sum(tf)::BIGINT AS count FROM POST GROUP BY term)), "
        "(SELECT sum(1.0 / i) AS hn FROM range(1, (SELECT sum(tf) FROM POST)::BIGINT + 1) t(i))"),
    "inverted_index": with_(P, POST) + "SELECT term, pid, tf, word_count::BIGINT AS word_count FROM POST",
    "document_frequency": with_(P, POST, DF) + "SELECT term, df, cf FROM DF",
    "corpus_stats": with_(P, POST, PL_) + (
        "SELECT (SELECT count(*) FROM P)::BIGINT AS n_passages, " + r6("(SELECT avg(wc) FROM PLEN)") + " AS avdl, "
        "(SELECT sum(wc) FROM PLEN)::BIGINT AS total_words, (SELECT count(DISTINCT pid) FROM POST)::BIGINT AS n_nonempty, "
        "(SELECT sum(tf) FROM POST)::BIGINT AS total_tokens, (SELECT count(DISTINCT term) FROM POST)::BIGINT AS vocabulary_size"),
    "tfidf_passage": with_(*BASE, PVEC) + f"SELECT pid, term, {r6('weight')} AS weight FROM PV",
    "tfidf_query": with_(*BASE, QVEC) + f"SELECT qid, term, k, {r6('weight')} AS weight FROM QV",
    "tfidf_cosine": scored("tfidf_cosine"),
    "bm25": scored("bm25"),
    "bm25_prefix100": bm25_prefix100(),
    "bm25_top10": with_(*BASE, PAIRTERM, BM25) + (
        f"SELECT qid, pid, {r6('score')} AS score, rank FROM (SELECT qid, pid, score, row_number() OVER "
        f"(PARTITION BY qid ORDER BY round(score, 9) DESC, ord) AS rank FROM BM) WHERE rank <= 10"),
    "laplace": scored("laplace"),
    "lidstone": scored("lidstone"),
    "dirichlet": scored("dirichlet"),
    "run_union": run_union(),
    "bm25_labelled": with_(*BASE, *labelled("bm25")) + (
        f"SELECT qid, pid, {r6('score')} AS score, relevancy, grade, rank FROM RUN_BM"),
    "average_precision": with_(*BASE, *labelled("bm25"), ap_cte("BM")) + (
        f"SELECT qid, {r6('ave_precision')} AS ave_precision FROM AP_BM"),
    "ndcg_global": with_(*BASE, *labelled("bm25"), dcg_cte("BM"), ndcg_global_cte("BM")) + (
        f"SELECT qid, {r6('dcg')} AS dcg, {r6('ndcg')} AS ndcg FROM NG_BM"),
    "ndcg_ideal": with_(*BASE, *labelled("bm25"), dcg_cte("BM"), ndcg_ideal_cte("BM")) + (
        f"SELECT qid, {r6('dcg')} AS dcg, {r6('ndcg')} AS ndcg FROM NI_BM"),
    "map_ndcg_summary": summary_sql(),
    "run_file_rows": with_(*BASE, PAIRTERM, BM25) + (
        f"SELECT qid, 'A1' AS A, pid, rank, {r6('score')} AS score, 'BM25' AS algoname FROM ("
        f"SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, ord) AS rank "
        f"FROM BM) WHERE rank <= 100"),
    "label_histogram": with_(*BASE, LAB) + "SELECT relevancy, count(*)::BIGINT AS n FROM LAB GROUP BY relevancy",
    "avg_word_vectors": avg_word_vectors_sql(),
    "libsvm_roundtrip": LIBSVM_ROUNDTRIP,
    "factorised_descent": factorised_descent_sql(),
    "factorised_predict": factorised_predict_sql(),
    "logistic_step": LOGISTIC_STEP,
    "logistic_predict": LOGISTIC_PREDICT,
}
