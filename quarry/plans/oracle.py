"""DuckDB SQL for every catalog entry that SQL can express.

Built from the same fixed values as the Spark code (tokenizer pattern, stop words, Porter rules), so
the two engines run the same definitions. Views ``documents``, ``conversations``, ``benchmark`` and
``pages`` are registered by the caller.
"""

from __future__ import annotations

from quarry.functions.porter import porter_sql
from quarry.functions.stopwords import FIRST_STOP_WORDS, REST_STOP_WORDS
from quarry.functions.tokenize import sql_token_pattern
from quarry.functions.normalize import NUMBER_PATTERN
from quarry.plans.catalog import (
    BENCHMARK_QUERY_OFFSET, CHAIN_QUERY_ID, LINK_PAGE, LOOKUP_TERM, ODD_PAGES, QUERY_SET, REJECT_PAGES, REJECT_ROWS,
    SEEDED_K, SQL_KMEANS_K,
)
from quarry.operators.cluster import DEFAULT_KS, SCORE_DIGITS, TOO_FEW_DOCUMENTS, TOP_TERMS
from quarry.operators.links import (
    DENIED_PATTERN, DIR_PATTERN, DOTS_PATTERN, ENTITIES, HOST_PATTERN, HREF_PATTERN, LINK_RULES, ORIGIN_PATTERN, PATH_PATTERN,
    SCHEME_PATTERN, TAIL_PATTERN, WEB_PATTERN,
)
from quarry.operators import seeding
from quarry.operators.render import BUCKET_WIDTH
from quarry.operators.store import BLOCK_DOCS
from quarry.plans.catalog import DOC_LIMIT, LINK_DOMAIN, VOCAB_CAPACITY


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rows(rows, types) -> str:
    """``VALUES`` rows of fixed values, with the types of the columns."""
    def value(v, t):
        return f"CAST({'NULL' if v is None else _lit(v) if isinstance(v, str) else v} AS {t})"
    return ", ".join("(" + ", ".join(value(v, t) for v, t in zip(r, types)) + ")" for r in rows)


def _too_few(k: str, n: str) -> str:
    """The guard's line in SQL, for SQL expressions of k and the number of documents."""
    head, mid, tail = TOO_FEW_DOCUMENTS.split("%d")
    return f"{_lit(head)} || {k} || {_lit(mid)} || {n} || {_lit(tail)}"


def _in_list(words) -> str:
    return "(" + ", ".join(_lit(w) for w in words) + ")"


PAT = sql_token_pattern()


def tokens_cte(name: str, src: str) -> str:
    """``name(doc_id, pos, token)`` from ``src(doc_id, text)``."""
    return (f"{name} AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS pos, unnest(t) AS token "
            f"FROM (SELECT CAST(doc_id AS BIGINT) AS doc_id, regexp_extract_all(text, '{PAT}') AS t FROM {src}))")


def paged_tokens_cte(name: str, src: str) -> str:
    """``name(doc_id, pos, token)`` from ``src(doc_id, page_no, text)`` with running positions."""
    return (f"{name}_p AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(page_no AS BIGINT) AS page_no, "
            f"text, regexp_extract_all(text, '{PAT}') AS t FROM {src}), "
            f"{name}_o AS (SELECT doc_id, page_no, t, coalesce(sum(coalesce(len(t), 0)) OVER (PARTITION BY doc_id "
            f"ORDER BY page_no NULLS FIRST, text NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM {name}_p), "
            f"{name} AS (SELECT doc_id, CAST(off + unnest(range(1, len(t) + 1)) AS BIGINT) AS pos, unnest(t) AS token "
            f"FROM {name}_o)")


def norm_ctes(prefix: str, toks: str, stem: bool = True) -> str:
    """``{prefix}_terms(doc_id, pos, term)``: full normalization chain over ``toks``."""
    ctes = [
        f"{prefix}_n1 AS (SELECT doc_id, pos, lower(token) AS term FROM {toks} "
        f"WHERE NOT regexp_matches(token, '{NUMBER_PATTERN}'))",
        f"{prefix}_n2 AS (SELECT doc_id, pos, term FROM {prefix}_n1 WHERE term NOT IN {_in_list(FIRST_STOP_WORDS)} "
        f"AND term NOT IN {_in_list(REST_STOP_WORDS)})",
    ]
    if stem:
        ctes.append(f"{prefix}_v AS (SELECT DISTINCT term FROM {prefix}_n2)")
        ctes.append(f"{prefix}_s AS ({porter_sql(prefix + '_v', 'term', 'stem')})")
        ctes.append(f"{prefix}_terms AS (SELECT n.doc_id, n.pos, s.stem AS term FROM {prefix}_n2 n "
                    f"JOIN {prefix}_s s ON n.term = s.term)")
    else:
        ctes.append(f"{prefix}_terms AS (SELECT doc_id, pos, term FROM {prefix}_n2)")
    return ", ".join(ctes)


def postings_cte(name: str, terms: str) -> str:
    return (f"{name} AS (SELECT term, doc_id, CAST(count(*) AS BIGINT) AS tf, "
            f"list_sort(list(pos)) AS plist FROM {terms} GROUP BY term, doc_id)")


def _positions(col: str = "plist") -> str:
    return f"array_to_string({col}, ',')"


DOCS = "docs AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM documents)"
DOC_BASE = ", ".join([DOCS, tokens_cte("toks", "docs"), norm_ctes("d", "toks"), postings_cte("post", "d_terms")])
HAS_TOKEN = r"[^\s\x0B\p{Z}]"
NONEMPTY = f"ne AS (SELECT DISTINCT doc_id FROM docs WHERE regexp_matches(text, '{HAS_TOKEN}'))"
CONV = ("conv AS (SELECT CAST(conv_id AS BIGINT) AS doc_id, CAST(turn AS BIGINT) AS page_no, text "
        "FROM conversations)")
PAGE_TYPES = ("BIGINT", "BIGINT", "VARCHAR")


def _queries_cte() -> str:
    vals = ", ".join(f"({qid}, {_lit(q)})" for qid, q in QUERY_SET)
    return (f"qs AS (SELECT CAST(query_id AS BIGINT) AS query_id, query FROM (VALUES {vals}) v(query_id, query) "
            f"UNION ALL SELECT CAST(item_id + {BENCHMARK_QUERY_OFFSET} AS BIGINT), text FROM benchmark)")


QUERY_BASE = ", ".join([
    DOC_BASE, _queries_cte(),
    tokens_cte("qtok", "(SELECT query_id AS doc_id, trim(query) AS text FROM qs)"),
    norm_ctes("q", "qtok"),
    "qt AS (SELECT DISTINCT doc_id AS query_id, term FROM q_terms)",
    "nt AS (SELECT query_id, count(*) AS n_terms FROM qt GROUP BY query_id)",
    "hits AS (SELECT qt.query_id, p.doc_id FROM qt JOIN post p ON p.term = qt.term "
    "GROUP BY qt.query_id, p.doc_id HAVING count(*) = (SELECT n_terms FROM nt WHERE nt.query_id = qt.query_id))",
    "known AS (SELECT qt.query_id, count(*) AS n_known FROM qt WHERE qt.term IN (SELECT term FROM post) "
    "GROUP BY qt.query_id)",
    "nh AS (SELECT query_id, count(*) AS n_hits FROM hits GROUP BY query_id)",
    "status AS (SELECT qs.query_id, CASE WHEN coalesce(nt.n_terms, 0) = 0 THEN 'invalid' "
    "WHEN coalesce(known.n_known, 0) < nt.n_terms THEN 'missing_term' "
    "WHEN coalesce(nh.n_hits, 0) = 0 THEN 'empty' ELSE 'hits' END AS status, "
    "CAST(coalesce(nt.n_terms, 0) AS BIGINT) AS n_terms, CAST(coalesce(nh.n_hits, 0) AS BIGINT) AS n_hits "
    "FROM qs LEFT JOIN nt USING (query_id) LEFT JOIN known USING (query_id) LEFT JOIN nh USING (query_id))",
])


TFIDF_BASE = ", ".join([
    DOC_BASE, NONEMPTY,
    "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ne)",
    "idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT n FROM nn)) / (1.0::DOUBLE + CAST(count(*) AS DOUBLE))) "
    "+ 1.0::DOUBLE AS idf FROM post GROUP BY term)",
    "raw AS (SELECT p.doc_id, p.term, CAST(p.tf AS DOUBLE) * idf.idf AS r FROM post p JOIN idf USING (term))",
    "wt AS MATERIALIZED (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS w FROM raw)",
])


# Update steps that the SQL unrolls: more than the fixed point needs on the tables compared, and
# nothing changes after it.
KMEANS_STEPS = 40


# A query's terms rarest first (``path``), the ranges of documents where all of them can meet (``asked``), how many of its
# leading terms some document of a range holds (``led``), and the beginnings where paths part or end (``cuts``).
SHARED_CTES = ", ".join([
    "vocab AS (SELECT term, row_number() OVER (ORDER BY term) AS term_id, count(*) AS df FROM post GROUP BY term)",
    "complete AS (SELECT query_id, n_terms FROM status WHERE status IN ('empty', 'hits'))",
    f"heads AS (SELECT term, CAST(floor(doc_id / {BLOCK_DOCS}) AS BIGINT) AS block, min(doc_id) AS lo, max(doc_id) AS hi FROM post GROUP BY ALL)",
    "asked AS (SELECT query_id, block FROM qt JOIN complete USING (query_id) JOIN heads USING (term) GROUP BY query_id, block, n_terms "
    "HAVING count(*) = n_terms AND max(lo) <= min(hi))",
    "path AS (SELECT query_id, term, row_number() OVER w AS pos, string_agg(CAST(term_id AS VARCHAR), ',') OVER w AS prefix "
    "FROM qt JOIN vocab USING (term) WHERE query_id IN (SELECT query_id FROM asked) "
    "WINDOW w AS (PARTITION BY query_id ORDER BY df, term_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
    "met AS (SELECT query_id, pos, doc_id, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY pos) AS nth "
    "FROM path JOIN post USING (term))",
    f"led AS (SELECT query_id, CAST(floor(doc_id / {BLOCK_DOCS}) AS BIGINT) AS block, max(pos) AS most FROM met WHERE pos = nth GROUP BY ALL)",
    "steps AS (SELECT *, lead(term) OVER (PARTITION BY query_id ORDER BY pos) AS nxt FROM path)",
    "nodes AS (SELECT prefix FROM steps GROUP BY prefix HAVING count(*) > count(nxt) OR count(DISTINCT nxt) > 1)",
    "cuts AS (SELECT query_id, prefix, row_number() OVER w AS level, coalesce(lag(pos) OVER w, 0) AS since, pos "
    "FROM path JOIN nodes USING (prefix) WINDOW w AS (PARTITION BY query_id ORDER BY pos))",
    "edges AS (SELECT level, prefix, block, pos - since - CASE WHEN level = 1 THEN 1 ELSE 0 END AS n, count(*) AS through "
    "FROM cuts JOIN asked USING (query_id) LEFT JOIN led USING (query_id, block) WHERE level = 1 OR most >= since GROUP BY ALL)",
])


def _kmeans_ctes(k: int, iterations: int, p: str = "", seeds: str | None = None) -> tuple[str, str, str]:
    """CTEs of the deterministic k-means (names prefixed with ``p``, from ``seeds`` or the first documents); returns (ctes,
    final labels name, final centroids name)."""
    d = SCORE_DIGITS
    ctes = [f"{p}seeds AS ({seeds})"] if seeds else [
        f"{p}seeds AS (SELECT doc_id, CAST(rn - 1 AS BIGINT) AS cluster FROM (SELECT doc_id, row_number() OVER "
        f"(ORDER BY doc_id) AS rn FROM (SELECT DISTINCT doc_id FROM wt)) WHERE rn <= {k})",
    ]

    def centroids(name, labels):
        return (f"{name} AS MATERIALIZED (SELECT l.cluster, x.term, sum(x.w) / (SELECT count(*) FROM {labels} z "
                f"WHERE z.cluster = l.cluster) AS w FROM wt x JOIN {labels} l USING (doc_id) GROUP BY l.cluster, x.term)")

    def assign(name, cents):
        return (f"{name}_n2 AS (SELECT cluster, sum(w * w) AS n2 FROM {cents} GROUP BY cluster), "
                f"{name}_be AS (SELECT cluster, round(n2, {d}) AS s FROM {name}_n2 ORDER BY round(n2, {d}), cluster "
                f"LIMIT 1), "
                f"{name}_sc AS (SELECT x.doc_id, c.cluster, round(n.n2 - 2.0::DOUBLE * sum(x.w * c.w), {d}) AS score "
                f"FROM wt x JOIN {cents} c ON x.term = c.term JOIN {name}_n2 n ON n.cluster = c.cluster "
                f"GROUP BY x.doc_id, c.cluster, n.n2), "
                f"{name}_all AS (SELECT doc_id, cluster, score FROM {name}_sc UNION ALL "
                f"SELECT ne.doc_id, be.cluster, be.s FROM ne, {name}_be be), "
                f"{name} AS MATERIALIZED (SELECT doc_id, cluster FROM (SELECT doc_id, cluster, row_number() OVER "
                f"(PARTITION BY doc_id ORDER BY score, cluster) AS rn FROM {name}_all) WHERE rn = 1)")

    ctes.append(centroids(f"{p}c0", f"{p}seeds"))
    prev = f"{p}c0"
    for i in range(1, iterations + 1):
        ctes.append(assign(f"{p}l{i}", prev))
        ctes.append(centroids(f"{p}cn{i}", f"{p}l{i}"))
        ctes.append(f"{p}c{i} AS MATERIALIZED (SELECT * FROM {p}cn{i} UNION ALL SELECT * FROM {prev} "
                    f"WHERE cluster NOT IN (SELECT cluster FROM {p}l{i}))")
        prev = f"{p}c{i}"
    ctes.append(assign(f"{p}lf", prev))
    return ", ".join(ctes), f"{p}lf", prev


def _report_sql(ks, iterations: int) -> str:
    """The cluster report of the deterministic k-means for each k (stops at the first k > n)."""
    ctes, blocks, prev_k = [TFIDF_BASE, "nd AS (SELECT count(*) AS n FROM ne)"], [], 0
    for k in ks:
        km, lab, cen = _kmeans_ctes(k, iterations, f"k{k}_")
        ctes.append(km)
        ok = f"(SELECT n FROM nd) >= {k}"
        blocks.append(
            f"SELECT CAST({k} AS BIGINT) AS k, 0 AS section, CAST(-1 AS BIGINT) AS cluster, "
            f"{_too_few(str(k), '(SELECT n FROM nd)')} AS line "
            f"WHERE (SELECT n FROM nd) < {k} AND (SELECT n FROM nd) >= {prev_k}")
        blocks.append(f"SELECT CAST({k} AS BIGINT), 0, CAST(-1 AS BIGINT), 'k = {k}' WHERE {ok}")
        blocks.append(
            f"SELECT CAST({k} AS BIGINT), 1, c.cluster, 'Cluster ' || c.cluster || ': ' || "
            f"coalesce(m.ids, 'No documents') FROM (SELECT CAST(range AS BIGINT) AS cluster FROM range({k})) c "
            f"LEFT JOIN (SELECT cluster, string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS ids "
            f"FROM {lab} GROUP BY cluster) m USING (cluster) WHERE {ok}")
        blocks.append(
            f"SELECT CAST({k} AS BIGINT), 2, c.cluster, 'Cluster ' || c.cluster || ':' || chr(10) || "
            f"coalesce(t.line, '') FROM (SELECT CAST(range AS BIGINT) AS cluster FROM range({k})) c LEFT JOIN "
            f"(SELECT cluster, string_agg(printf('%s: %.4f', term, w), ', ' ORDER BY rn) AS line FROM "
            f"(SELECT cluster, term, w, row_number() OVER (PARTITION BY cluster ORDER BY round(w, {SCORE_DIGITS}) "
            f"DESC, term) AS rn FROM {cen} WHERE w > 0) WHERE rn <= {TOP_TERMS} GROUP BY cluster) t USING (cluster) "
            f"WHERE {ok}")
        prev_k = k
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(blocks)


def _seed_ctes(k: int, runs: int, rounds: int, per_round: int, seed: int) -> str:
    """CTEs ending in ``drawn(run, doc_id, cluster)``: the seeds of every run by weighted draws."""
    d = seeding.DIGITS

    def race(step: str, weight: str) -> str:
        return f"round(-ln({seeding.uniform_sql(seed, 'run', step, 'doc_id')}) / ({weight}), {d})"

    def nearest(name: str, cands: str) -> str:
        return (f"{name}_dot AS (SELECT c.run, a.doc_id, c.doc_id AS near, sum(a.w * b.w) AS dot FROM {cands} c JOIN wt b ON b.doc_id = c.doc_id "
                f"JOIN wt a ON a.term = b.term GROUP BY ALL), "
                f"{name}_all AS (SELECT c.run, x.doc_id, c.doc_id AS near, round(x.x2 + y.x2 - 2.0::DOUBLE * coalesce(dot, 0.0::DOUBLE), {d}) AS d FROM {cands} c "
                f"JOIN x2 y ON y.doc_id = c.doc_id, x2 x LEFT JOIN {name}_dot t ON t.run = c.run AND t.doc_id = x.doc_id AND t.near = c.doc_id), "
                f"{name} AS MATERIALIZED (SELECT run, doc_id, d, near FROM (SELECT *, row_number() OVER (PARTITION BY run, doc_id ORDER BY d, near) AS rn "
                f"FROM {name}_all) WHERE rn = 1)")

    ctes = ["x2 AS MATERIALIZED (SELECT doc_id, sum(w * w) AS x2 FROM wt GROUP BY doc_id)",
            f"rs AS (SELECT CAST(range AS INTEGER) AS run FROM range({runs}))",
            f"cand0 AS MATERIALIZED (SELECT run, doc_id FROM (SELECT run, doc_id, row_number() OVER (PARTITION BY run ORDER BY {race('0', '1.0::DOUBLE')}, doc_id) AS rn "
            "FROM x2, rs) WHERE rn = 1)"]
    for step in range(1, rounds + 1):
        ctes.append(nearest(f"near{step}", f"cand{step - 1}"))
        ctes.append(f"cand{step} AS MATERIALIZED (SELECT run, doc_id FROM cand{step - 1} UNION ALL SELECT run, doc_id FROM (SELECT run, doc_id, "
                    f"row_number() OVER (PARTITION BY run ORDER BY {race(str(step), 'd')}, doc_id) AS rn FROM near{step} WHERE d > 0) WHERE rn <= {per_round})")
    ctes.append(nearest("nearf", f"cand{rounds}"))
    ctes.append("cnt AS MATERIALIZED (SELECT run, near AS doc_id, count(*) AS n FROM nearf GROUP BY ALL)")
    ctes.append("drawn0 AS (SELECT CAST(NULL AS INTEGER) AS run, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS BIGINT) AS cluster WHERE false)")
    for i in range(k):
        ctes.append(f"far{i} AS (SELECT c.run, c.doc_id, c.n, coalesce(min(a.d), 1.0::DOUBLE) AS far FROM cnt c LEFT JOIN drawn{i} p ON p.run = c.run "
                    "LEFT JOIN nearf_all a ON a.run = c.run AND a.doc_id = c.doc_id AND a.near = p.doc_id GROUP BY c.run, c.doc_id, c.n)")
        ctes.append(f"drawn{i + 1} AS MATERIALIZED (SELECT * FROM drawn{i} UNION ALL SELECT run, doc_id, CAST({i} AS BIGINT) FROM (SELECT run, doc_id, row_number() OVER "
                    f"(PARTITION BY run ORDER BY {race(f'p{i}', 'n * far')}, doc_id) AS rn FROM far{i} WHERE far > 0) WHERE rn = 1)")
    ctes.append(f"drawn AS MATERIALIZED (SELECT run, doc_id, cluster FROM drawn{k})")
    return ", ".join(ctes)


def _best_run_ctes(k: int, runs: int) -> str:
    """CTEs ending in ``best(doc_id, cluster)``: the labels of the run of least cost from ``drawn``."""
    ctes, labels, costs = [], [], []
    for r in range(runs):
        km, lab, cen = _kmeans_ctes(k, KMEANS_STEPS, f"r{r}_", f"SELECT doc_id, cluster FROM drawn WHERE run = {r}")
        ctes += [km, f"cost{r} AS (SELECT {r} AS run, round((SELECT sum(x2) FROM x2) - (SELECT sum(m.n2 * s.n) FROM (SELECT cluster, sum(w * w) AS n2 FROM {cen} "
                     f"GROUP BY cluster) m JOIN (SELECT cluster, count(*) AS n FROM {lab} GROUP BY cluster) s USING (cluster)), 6) AS cost)"]
        labels.append(f"SELECT {r} AS run, doc_id, cluster FROM {lab}")
        costs.append(f"SELECT run, cost FROM cost{r}")
    ctes.append(f"best AS (SELECT doc_id, cluster FROM ({' UNION ALL '.join(labels)}) WHERE run = (SELECT run FROM ({' UNION ALL '.join(costs)}) ORDER BY cost, run LIMIT 1))")
    return ", ".join(ctes)


def _entities(col: str) -> str:
    for entity, char in ENTITIES:
        col = f"replace({col}, {_lit(entity)}, {_lit(char)})"
    return col


def _with(base: str, select: str) -> str:
    return f"WITH {base} {select}"


def oracle_sql() -> dict[str, str]:
    tok_base = ", ".join([DOCS, tokens_cte("toks", "docs")])
    n1 = f"WHERE NOT regexp_matches(token, '{NUMBER_PATTERN}')"
    sq = {
        "tokens": _with(tok_base, "SELECT doc_id, pos, token FROM toks"),
        "tokens_paged": _with(", ".join([CONV, f"odd AS (SELECT * FROM conv UNION ALL VALUES {_rows(ODD_PAGES, PAGE_TYPES)})",
                                         paged_tokens_cte("pt", "odd")]),
                              "SELECT doc_id, pos, token FROM pt"),
        "remove_numbers": _with(tok_base, f"SELECT doc_id, pos, token AS term FROM toks {n1}"),
        "casefold": _with(tok_base, "SELECT doc_id, pos, lower(token) AS term FROM toks"),
        "stop30": _with(tok_base, f"SELECT doc_id, pos, lower(token) AS term FROM toks "
                                  f"WHERE lower(token) NOT IN {_in_list(FIRST_STOP_WORDS)}"),
        "stop_rest": _with(tok_base, f"SELECT doc_id, pos, lower(token) AS term FROM toks "
                                     f"WHERE lower(token) NOT IN {_in_list(REST_STOP_WORDS)}"),
        "normalize_nostem": _with(", ".join([tok_base, norm_ctes("d", "toks", stem=False)]),
                                  "SELECT doc_id, pos, term FROM d_terms"),
        "normalize": _with(", ".join([tok_base, norm_ctes("d", "toks")]), "SELECT doc_id, pos, term FROM d_terms"),
        "porter_vocab": _with(", ".join([tok_base, norm_ctes("d", "toks")]), "SELECT term, stem FROM d_s"),
        "postings": _with(DOC_BASE, f"SELECT term, doc_id, tf, {_positions()} AS positions FROM post"),
        "merge_postings": _with(
            ", ".join([DOC_BASE, CONV, paged_tokens_cte("ct", "conv"), norm_ctes("c", "ct"),
                       postings_cte("cpost", "c_terms")]),
            "SELECT term, doc_id, CAST(sum(tf) AS BIGINT) AS tf, "
            "array_to_string(list_sort(flatten(list(plist))), ',') AS positions "
            "FROM (SELECT * FROM post UNION ALL SELECT * FROM cpost) GROUP BY term, doc_id"),
        "term_stats": _with(DOC_BASE, "SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf "
                                      "FROM post GROUP BY term"),
        "collection_stats": _with(", ".join([DOC_BASE, NONEMPTY]),
                                  "SELECT (SELECT CAST(count(*) AS BIGINT) FROM ne) AS n_docs, "
                                  "CAST(count(DISTINCT term) AS BIGINT) AS n_terms, "
                                  "CAST(count(*) AS BIGINT) AS n_postings, CAST(sum(tf) AS BIGINT) AS n_tokens "
                                  "FROM post"),
        "term_lookup": _with(DOC_BASE, f"SELECT term, doc_id, tf, {_positions()} AS positions FROM post "
                                       f"WHERE term = {_lit(LOOKUP_TERM)}"),
        "term_dictionary": _with(DOC_BASE, "SELECT term, CAST(row_number() OVER (ORDER BY term) AS BIGINT) AS term_id, "
                                           "CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM post GROUP BY term"),
        "index_dump": _with(DOC_BASE,
                            "SELECT term, CAST(count(*) AS BIGINT) AS df, term || ' (' || count(*) || ') --> ' || "
                            "string_agg(CAST(doc_id AS VARCHAR) || '[' || array_to_string(plist, ', ') || ']', ', ' "
                            "ORDER BY doc_id) AS line FROM post GROUP BY term"),
        "query_terms": _with(", ".join([_queries_cte(),
                                        tokens_cte("qtok", "(SELECT query_id AS doc_id, trim(query) AS text FROM qs)"),
                                        norm_ctes("q", "qtok")]),
                             "SELECT doc_id AS query_id, pos, term FROM q_terms"),
        "query_postings": _with(", ".join([_queries_cte(),
                                           tokens_cte("qtok", "(SELECT query_id AS doc_id, trim(query) AS text FROM qs)"),
                                           norm_ctes("q", "qtok")]),
                                "SELECT doc_id AS query_id, term, CAST(row_number() OVER (PARTITION BY doc_id "
                                "ORDER BY pos) - 1 AS BIGINT) AS qpos FROM q_terms"),
        "and_query": _with(QUERY_BASE, "SELECT query_id, doc_id FROM hits"),
        "and_query_semijoin": _with(QUERY_BASE, "SELECT query_id, doc_id FROM hits"),
        "and_blocks": _with(QUERY_BASE, "SELECT query_id, doc_id FROM hits"),
        "and_shared": _with(QUERY_BASE, "SELECT query_id, doc_id FROM hits"),
        "and_shared_work": _with(f"{QUERY_BASE}, {SHARED_CTES}",
                                 "SELECT CAST(level AS INTEGER) AS level, CAST(sum(n) AS BIGINT) AS n_shared, "
                                 "CAST(sum(n * through) AS BIGINT) AS n_alone FROM edges GROUP BY level"),
        "query_status": _with(QUERY_BASE, "SELECT query_id, status, n_terms, n_hits FROM status"),
        "result_text": _with(QUERY_BASE,
                             "SELECT s.query_id, CASE WHEN s.n_hits > 0 THEN 'Retrieved Document IDs (' || s.n_hits "
                             "|| '): ' || (SELECT string_agg(CAST(h.doc_id AS VARCHAR), ', ' ORDER BY h.doc_id) "
                             "FROM hits h WHERE h.query_id = s.query_id) ELSE 'No documents returned.' END AS line "
                             "FROM status s"),
        "result_parts": _with(QUERY_BASE, f"SELECT query_id, CAST(floor(doc_id / {BUCKET_WIDTH}) AS BIGINT) AS part, count(*) AS n, "
                              "string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS line FROM hits GROUP BY ALL"),
        "session_parts": _with(QUERY_BASE, f"SELECT CAST(floor(doc_id / {BUCKET_WIDTH}) AS BIGINT) AS part, count(*) AS n, "
                               "string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS line "
                               "FROM (SELECT DISTINCT doc_id FROM hits) GROUP BY ALL"),
        "and_chain": _with(QUERY_BASE, f"SELECT doc_id FROM hits WHERE query_id = {CHAIN_QUERY_ID}"),
        "postings_parts": _with(DOC_BASE, f"SELECT term, CAST(floor(doc_id / {BUCKET_WIDTH}) AS BIGINT) AS part, count(*) AS n, "
                                "string_agg(CAST(doc_id AS VARCHAR) || '[' || array_to_string(plist, ', ') || ']', ', ' "
                                "ORDER BY doc_id) AS line FROM post GROUP BY term, part"),
        "session_union": _with(QUERY_BASE, "SELECT DISTINCT doc_id FROM hits"),
        "session_text": _with(QUERY_BASE,
                              "SELECT CASE WHEN count(*) = 0 THEN 'No documents were retrieved during your session.' "
                              "ELSE 'Documents retrieved (' || count(*) || '): ' || string_agg(CAST(doc_id AS VARCHAR), "
                              "', ' ORDER BY doc_id) END AS line FROM (SELECT DISTINCT doc_id FROM hits)"),
    }
    km, lab, cen = _kmeans_ctes(SQL_KMEANS_K, KMEANS_STEPS)
    km_base = ", ".join([TFIDF_BASE, km])
    sq.update({
        "doc_term_matrix": _with(", ".join([DOC_BASE, NONEMPTY]),
                                 "SELECT doc_id, term, tf FROM post UNION ALL SELECT doc_id, CAST(NULL AS VARCHAR), "
                                 "CAST(0 AS BIGINT) FROM ne WHERE doc_id NOT IN (SELECT doc_id FROM post)"),
        "tfidf": _with(TFIDF_BASE, "SELECT doc_id, term, round(w, 6) AS w FROM wt"),
        "kmeans_assign": _with(km_base, f"SELECT doc_id, cluster FROM {lab}"),
        "kmeans_centroids": _with(km_base, f"SELECT cluster, term, round(w, 6) AS w FROM {cen}"),
        "cluster_members": _with(km_base,
                                 f"SELECT c.cluster, 'Cluster ' || c.cluster || ': ' || coalesce(m.ids, 'No documents') "
                                 f"AS line FROM (SELECT CAST(range AS BIGINT) AS cluster FROM range({SQL_KMEANS_K})) c "
                                 f"LEFT JOIN (SELECT cluster, string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) "
                                 f"AS ids FROM {lab} GROUP BY cluster) m USING (cluster)"),
        "cluster_member_parts": _with(km_base, f"SELECT cluster, CAST(floor(doc_id / {BUCKET_WIDTH}) AS BIGINT) AS part, count(*) AS n, "
                                      f"string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS line FROM {lab} GROUP BY ALL"),
        "kmeans_ml_check": _with(", ".join([DOCS, NONEMPTY]),
                                 "SELECT k, n AS n_labelled, true AS labels_valid, true AS cost_bounded FROM "
                                 f"(VALUES {_rows([(k,) for k in DEFAULT_KS], ('BIGINT',))}) v(k), (SELECT count(*) AS n FROM ne) WHERE n >= k"),
        "cluster_top_terms": _with(km_base,
                                   f"SELECT cluster, string_agg(printf('%s: %.4f', term, w), ', ' ORDER BY rn) AS line "
                                   f"FROM (SELECT cluster, term, w, row_number() OVER (PARTITION BY cluster ORDER BY "
                                   f"round(w, {SCORE_DIGITS}) DESC, term) AS rn FROM {cen} WHERE w > 0) "
                                   f"WHERE rn <= {TOP_TERMS} GROUP BY cluster"),
        "kmeans_guard": _with(NONEMPTY.replace("FROM docs", "FROM (SELECT doc_id, text FROM documents)"),
                              "SELECT k, line FROM (SELECT CAST(k AS BIGINT) AS k, CASE WHEN n < k THEN "
                              f"{_too_few('k', 'n')} ELSE 'ok' END AS line, "
                              "sum(CASE WHEN n < k THEN 1 ELSE 0 END) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED "
                              f"PRECEDING AND 1 PRECEDING) AS prior_fail FROM (SELECT * FROM (VALUES {_rows([(k,) for k in DEFAULT_KS], ('BIGINT',))}) "
                              "v(k) UNION ALL SELECT count(*) + 1 FROM ne) v, (SELECT count(*) AS n FROM ne)) WHERE coalesce(prior_fail, 0) = 0"),
    })
    lk_base = (
        "pg AS (SELECT CAST(page_id AS BIGINT) AS page_id, url AS base, html FROM pages UNION ALL "
        f"VALUES {_rows([LINK_PAGE], ('BIGINT', 'VARCHAR', 'VARCHAR'))}), "
        "hr AS (SELECT page_id, base, unnest(range(1, len(h) + 1)) AS link_no, unnest(h) AS raw FROM "
        f"(SELECT page_id, base, regexp_extract_all(html, {_lit(HREF_PATTERN)}, 1) AS h FROM pg)), "
        "hv AS (SELECT page_id, base, link_no, CASE WHEN raw[1] IN ('\"', chr(39)) THEN raw[2:-2] ELSE raw END AS v FROM hr), "
        f"he AS (SELECT page_id, base, link_no, regexp_replace(trim({_entities('v')}), '(?s)#.*$', '') AS href FROM hv), "
        f"ab AS (SELECT page_id, link_no, CASE WHEN regexp_matches(href, {_lit(SCHEME_PATTERN)}) THEN href "
        "WHEN starts_with(href, '//') THEN regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href "
        f"WHEN starts_with(href, '/') THEN regexp_extract(base, {_lit(ORIGIN_PATTERN)}, 0) || href "
        "WHEN starts_with(href, '?') THEN regexp_extract(base, '^[^?#]*', 0) || href "
        f"ELSE regexp_extract(base, {_lit(ORIGIN_PATTERN)}, 0) || coalesce(nullif(regexp_extract(base, {_lit(DIR_PATTERN)}, 1), ''), '/') "
        f"|| href END AS u FROM he WHERE href <> '' AND (regexp_matches(href, {_lit(WEB_PATTERN)}) OR NOT regexp_matches(href, {_lit(SCHEME_PATTERN)}))), "
        f"sg AS (SELECT page_id, link_no, u, string_split(regexp_extract(u, {_lit(PATH_PATTERN)}, 1), '/') AS seg FROM ab), "
        "wk AS (SELECT page_id, link_no, u, seg, list_reduce(seg[2:], lambda acc, x: CASE WHEN x = '.' THEN acc WHEN x = '..' "
        "THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END, '') AS walked FROM sg), "
        f"lk AS (SELECT page_id, link_no, CASE WHEN regexp_matches(regexp_extract(u, {_lit(PATH_PATTERN)}, 1), {_lit(DOTS_PATTERN)}) THEN "
        f"regexp_extract(u, {_lit(ORIGIN_PATTERN)}, 0) || walked || CASE WHEN seg[-1] IN ('.', '..') OR walked = '' THEN '/' ELSE '' END "
        f"|| regexp_extract(u, {_lit(TAIL_PATTERN)}, 1) ELSE u END AS url FROM wk)")
    host = f"lower(regexp_extract(url, {_lit(HOST_PATTERN)}, 1))"
    denied = f"regexp_matches(url, {_lit(DENIED_PATTERN)})"
    found = {n: f"regexp_matches(url, {_lit(p)})" + ("" if n == 1 else f" AND NOT {denied}") for n, p, _ in LINK_RULES}
    rule = "CASE " + " ".join(f"WHEN {found[n]} THEN {n}" for n, _, _ in LINK_RULES) + " ELSE 0 END"
    cls = "CASE " + " ".join(f"WHEN {found[n]} THEN {_lit(c)}" for n, _, c in LINK_RULES) + " ELSE 'none' END"
    in_domain = f"({host} = {_lit(LINK_DOMAIN)} OR suffix({host}, {_lit('.' + LINK_DOMAIN)}))"
    ne_pages = (f"nep AS (SELECT CAST(page_id AS BIGINT) AS doc_id, url FROM pages "
                f"WHERE regexp_matches(html, '{HAS_TOKEN}'))")
    cap = (f"fo AS (SELECT term, doc_id AS fd, pos AS fp FROM (SELECT term, doc_id, pos, row_number() OVER "
           f"(PARTITION BY term ORDER BY doc_id, pos) AS rn FROM d_terms) WHERE rn = 1), "
           f"cut AS (SELECT fd, fp FROM (SELECT fd, fp, row_number() OVER (ORDER BY fd, fp) AS rk FROM fo) "
           f"WHERE rk = {VOCAB_CAPACITY}), "
           f"kept AS (SELECT t.doc_id, t.pos, t.term FROM d_terms t WHERE NOT EXISTS (SELECT 1 FROM cut) OR "
           f"EXISTS (SELECT 1 FROM cut WHERE t.doc_id < cut.fd OR (t.doc_id = cut.fd AND t.pos <= cut.fp)))")
    sq.update({
        "links": _with(lk_base, "SELECT page_id, link_no, url FROM lk"),
        "link_domain": _with(lk_base, f"SELECT page_id, link_no, url, {host} AS host FROM lk WHERE {host} = "
                                      f"{_lit(LINK_DOMAIN)} OR suffix({host}, {_lit('.' + LINK_DOMAIN)})"),
        "link_class": _with(lk_base, f"SELECT page_id, link_no, url, CAST({rule} AS BIGINT) AS rule, {cls} AS class "
                                     f"FROM lk"),
        "select_links": _with(lk_base, "SELECT row_number() OVER (ORDER BY page_id, link_no) AS doc_id, url, class FROM (SELECT url, page_id, link_no, "
                                       f"{cls} AS class FROM (SELECT url, page_id, link_no, row_number() OVER (PARTITION BY url ORDER BY page_id, "
                                       f"link_no) AS rn FROM lk WHERE {in_domain} AND {rule} > 0) WHERE rn = 1 ORDER BY page_id, link_no "
                                       f"LIMIT {DOC_LIMIT})"),
        "url_dedupe": _with(lk_base, "SELECT url, page_id, link_no FROM (SELECT url, page_id, link_no, row_number() "
                                     "OVER (PARTITION BY url ORDER BY page_id, link_no) AS rn FROM lk) WHERE rn = 1"),
        "url_filename": "SELECT CAST(page_id AS BIGINT) AS page_id, url, CAST(page_id AS VARCHAR) || '_' || "
                        "string_split(url, '/')[-1] AS file_name FROM pages",
        "manifest_lines": _with(ne_pages, "SELECT doc_id, doc_id || ') ' || url AS line FROM nep"),
        "manifest_roundtrip": _with(ne_pages, "SELECT doc_id, url FROM nep"),
        "token_log_lines": _with(", ".join([DOCS, tokens_cte("toks", "docs")]),
                                 "SELECT doc_id, pos, token || ' / Doc ID: ' || doc_id || ' / Pos: ' || pos AS line "
                                 "FROM toks"),
        "token_log_roundtrip": _with(", ".join([DOCS, tokens_cte("toks", "docs")]),
                                     "SELECT token, doc_id, pos FROM toks"),
        "nonempty_docs": _with(", ".join([DOCS, NONEMPTY]), "SELECT doc_id FROM ne"),
        "doc_limit": _with(", ".join([DOCS, NONEMPTY]), f"SELECT doc_id FROM ne ORDER BY doc_id LIMIT {DOC_LIMIT}"),
        "dense_ids": _with(", ".join([DOCS, NONEMPTY]),
                           "SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS dense_id FROM ne"),
        "vocab_cap": _with(", ".join([DOCS, tokens_cte("toks", "docs"), norm_ctes("d", "toks"), cap,
                                      postings_cte("cp", "kept")]),
                           f"SELECT term, doc_id, tf, {_positions()} AS positions FROM cp"),
        "rejects": "SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN doc_id IS NULL THEN 'null_id' ELSE 'null_text' "
                   f"END AS reason FROM (SELECT doc_id, text FROM documents UNION ALL VALUES {_rows(REJECT_ROWS, ('BIGINT', 'VARCHAR'))}) "
                   "WHERE doc_id IS NULL OR text IS NULL",
        "page_rejects": "WITH cp AS (SELECT CAST(conv_id AS BIGINT) AS doc_id, CAST(turn AS BIGINT) AS page_no, text "
                        f"FROM conversations UNION ALL VALUES {_rows(REJECT_PAGES, PAGE_TYPES)}), bad AS (SELECT DISTINCT doc_id FROM cp WHERE doc_id IS NOT NULL AND "
                        "(text IS NULL OR page_no IS NULL)) "
                        "SELECT doc_id, page_no, CASE WHEN text IS NULL OR page_no IS NULL THEN 'null_text' "
                        "ELSE 'document_rejected' END AS reason FROM cp WHERE doc_id IN (SELECT doc_id FROM bad) "
                        "UNION ALL SELECT doc_id, page_no, 'null_id' FROM cp WHERE doc_id IS NULL",
        "segment_ingest": sq["postings"],
        "stream_ingest": sq["postings"],
        "stream_stats": sq["collection_stats"],
        "cluster_report_sql": _report_sql(DEFAULT_KS, KMEANS_STEPS),
    })
    drawn = ", ".join([TFIDF_BASE, _seed_ctes(SEEDED_K, seeding.RUNS, seeding.ROUNDS, 2 * SEEDED_K, seeding.SEED)])
    sq["kmeans_seeds"] = _with(drawn, "SELECT run, doc_id, cluster FROM drawn")
    sq["kmeans_best"] = _with(f"{drawn}, {_best_run_ctes(SEEDED_K, seeding.RUNS)}", "SELECT doc_id, cluster FROM best")
    sq["capped_ingest"], sq["limited_ingest"] = sq["vocab_cap"], sq["doc_limit"]
    sq["seen_urls"] = sq["url_dedupe"]
    sq["arrival_numbers"] = sq["dense_ids"].replace("AS dense_id", "AS doc_no")
    return sq
