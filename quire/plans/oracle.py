"""ANSI-SQL (DuckDB dialect) equivalents of the catalogue queries, over the
base tables only: every input view is inlined as a CTE."""

from __future__ import annotations

from quire.plans.params import (ALL_KERNELS, ALL_TAGS, ANSWER_BLOCK_SIZE, ARTICLE_VOCAB, ETA, INDEX_BLOCK_SIZE, KERNELS,
                                MANY_KERNELS, MAX_ITERATIONS, MENTION_TERM, MIXED_SPREAD, PAIR_KERNELS, PAIR_TAGS,
                                POSTING_VOCAB, SEED, SPREAD, STORED_TERMS)
from quire.sources.tables import WIDE_MINUTE_COLUMNS

# --- input views ----------------------------------------------------------

V_ARTICLES = "v_articles AS (SELECT concat('doc', doc_id) AS title, text FROM documents)"

V_ARTICLE_LINES = """v_article_lines AS (
  SELECT doc_id, concat('X<page><title>doc', doc_id, '</title><text>',
                        replace(text, chr(10), ' '), '</text></page>YY') AS line
  FROM documents)"""


def vocab_cte(vocab: list[str], name: str = "vocab") -> str:
    rows = ", ".join(f"({i}, '{t}')" for i, t in enumerate(vocab))
    return f"{name}(idx, term) AS (VALUES {rows})"


V_POSTINGS = """v_postings AS (
  SELECT 1 AS posting_type, o_orderkey AS id,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 10 + 1 END AS accepted_answer,
         CAST(NULL AS BIGINT) AS parent_id, 0 AS score,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS tag
  FROM orders
  UNION ALL
  SELECT 2, l_orderkey * 10 + l_linenumber, CAST(NULL AS BIGINT), l_orderkey,
         CAST(floor(l_extendedprice / 100) AS INT) - 300, CAST(NULL AS VARCHAR)
  FROM lineitem)"""

V_POSTING_LINES = """v_posting_lines AS (
  SELECT concat(posting_type, ',', id, ',', coalesce(CAST(accepted_answer AS VARCHAR), ''), ',',
                coalesce(CAST(parent_id AS VARCHAR), ''), ',', score, ',', coalesce(tag, '')) AS line
  FROM v_postings)"""

V_SCORED = """v_scored AS (
  SELECT q.id, q.tag, greatest(0, max(a.score)) AS high_score
  FROM v_postings q JOIN v_postings a ON a.parent_id = q.id
  WHERE q.posting_type = 1 AND a.posting_type = 2
  GROUP BY q.id, q.tag)"""


def v_vectors(spread: int = 50000, name: str = "v_vectors", vocab: list[str] = POSTING_VOCAB) -> str:
    cases = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(vocab))
    tags = ", ".join(f"'{t}'" for t in vocab)
    return f"""{name} AS (
  SELECT CAST(CASE tag {cases} END AS BIGINT) * {spread} AS x,
         CAST(high_score AS BIGINT) AS y, id
  FROM v_scored WHERE tag IN ({tags}))"""


def v_centers(per_tag: int = 3, seed: int = 42, vectors: str = "v_vectors") -> str:
    return f"""v_centers AS (
  SELECT CAST(row_number() OVER (ORDER BY x, r) - 1 AS INT) AS center_id, x, y
  FROM (SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY md5(concat_ws(':', x, y, {seed})), y) AS r
        FROM (SELECT DISTINCT x, y FROM {vectors}) d) s
  WHERE r <= {per_tag})"""


def v_centers_global(kernels: int = 12, seed: int = 42, vectors: str = "v_vectors") -> str:
    return f"""v_centers AS (
  SELECT CAST(row_number() OVER (ORDER BY x, y) - 1 AS INT) AS center_id, x, y
  FROM (SELECT x, y FROM (SELECT DISTINCT x, y FROM {vectors}) d
        ORDER BY md5(concat_ws(':', x, y, {seed})), x, y LIMIT {kernels}) s)"""


def kmeans_cte(eta: float = 20.0, max_iter: int = 120, vectors: str = "v_vectors") -> str:
    """Recursive k-means over weighted points; km(it, i, x, y, moved)."""
    return f"""pw AS MATERIALIZED (SELECT x, y, count(*) AS w FROM {vectors} GROUP BY x, y),
km(it, i, x, y, moved) AS (
  SELECT 0, center_id, x, y, 1e18::DOUBLE FROM v_centers
  UNION ALL
  SELECT it + 1, i, nx, ny, (sum((nx-ox)*(nx-ox) + (ny-oy)*(ny-oy)) OVER ())::DOUBLE
  FROM (SELECT any_value(it) AS it, i, any_value(ox) AS ox, any_value(oy) AS oy,
               (sum(px*w) // sum(w))::BIGINT AS nx, (sum(py*w) // sum(w))::BIGINT AS ny
        FROM (SELECT km.it, km.i, km.x AS ox, km.y AS oy, pw.x AS px, pw.y AS py, w,
                     row_number() OVER (PARTITION BY pw.x, pw.y
                       ORDER BY (pw.x-km.x)*(pw.x-km.x) + (pw.y-km.y)*(pw.y-km.y), km.i) AS rn
              FROM km CROSS JOIN pw WHERE km.it < {max_iter} AND km.moved >= {eta}) a
        WHERE rn = 1 GROUP BY i) b),
final AS (SELECT i AS center_id, x, y FROM km WHERE it = (SELECT max(it) FROM km))"""



def v_wide() -> str:
    sums = ",\n         ".join(
        f"sum(CASE WHEN l_partkey % 20 = {i} THEN l_quantity * 10 ELSE 0 END) AS {c}"
        for i, c in enumerate(WIDE_MINUTE_COLUMNS))
    return f"""v_wide AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS tucaseid,
         CAST(o_custkey % 5 + 1 AS INT) AS telfs, CAST(o_orderkey % 2 + 1 AS INT) AS tesex,
         CAST(15 + o_custkey % 66 AS INT) AS teage,
         {sums}
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, o_custkey)"""


def _hours(cols: list[str]) -> str:
    return "(" + " + ".join(["0"] + cols) + ") / 60.0"


# Classification of the fixture's minute columns, each list in reverse column
# order as the classifier returns it.
WIDE_PRIMARY = ["t180301", "t180101", "t110101", "t030101", "t010102", "t010101"]
WIDE_WORK = ["t180501", "t050102", "t050101"]
WIDE_OTHER = ["t180201", "t160101", "t150101", "t130101", "t120101", "t080101",
              "t060101", "t040101", "t020101"]

V_SUMMARY = f"""v_summary AS (
  SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage >= 15 AND teage <= 22 THEN 'young'
              WHEN teage >= 23 AND teage <= 55 THEN 'active' ELSE 'elder' END AS age,
         {_hours(WIDE_PRIMARY)} AS primaryNeeds,
         {_hours(WIDE_WORK)} AS work,
         {_hours(WIDE_OTHER)} AS other
  FROM v_wide WHERE telfs <= 4)"""

GROUPED = """SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds,
       round(avg(work), 1) AS work, round(avg(other), 1) AS other
FROM v_summary GROUP BY working, sex, age ORDER BY working, sex, age"""


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def _classify_rows() -> str:
    rows = []
    for g, cols in (("primaryNeeds", WIDE_PRIMARY), ("work", WIDE_WORK), ("other", WIDE_OTHER)):
        rows += [f"('{c}', '{g}', {i})" for i, c in enumerate(cols)]
    return ", ".join(rows)


def _classify_sql() -> str:
    totals = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in WIDE_PRIMARY + WIDE_WORK + WIDE_OTHER)
    cases = " ".join(f"WHEN '{c}' THEN t.{c}" for c in WIDE_PRIMARY + WIDE_WORK + WIDE_OTHER)
    return (with_(v_wide(), f"t AS (SELECT {totals} FROM v_wide)",
                  f"cls(column_name, activity_group, pos) AS (VALUES {_classify_rows()})")
            + f"SELECT cls.column_name, cls.activity_group, CAST(cls.pos AS INT) AS pos, "
              f"CASE cls.column_name {cases} END AS minutes FROM cls, t")


def _typed_rows_sql() -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ["telfs", "tesex", "teage"] + WIDE_MINUTE_COLUMNS)
    return with_(v_wide()) + f"SELECT tucaseid, {cols} FROM v_wide"


SQL: dict[str, str] = {
    "classify_columns": _classify_sql(),
    "typed_rows": _typed_rows_sql(),
    "time_usage_summary": with_(v_wide(), V_SUMMARY) + "SELECT * FROM v_summary",
    "time_usage_typed": with_(v_wide(), V_SUMMARY)
        + "SELECT working, sex, age, coalesce(primaryNeeds, 0.0) AS primaryNeeds, "
          "coalesce(work, 0.0) AS work, coalesce(other, 0.0) AS other FROM v_summary",
    "time_usage_grouped": with_(v_wide(), V_SUMMARY) + GROUPED,
    "time_usage_grouped_sql": with_(v_wide(), V_SUMMARY) + GROUPED,
    "time_usage_grouped_typed": with_(v_wide(), V_SUMMARY) + GROUPED,
}


# --- articles -------------------------------------------------------------

def _mentions(term_sql: str, text: str = "a.text") -> str:
    return f"list_contains(string_split({text}, ' '), {term_sql})"


_ART = with_(V_ARTICLES, vocab_cte(ARTICLE_VOCAB))
_RANK = _ART + f"""SELECT v.term, count(a.title) AS n
FROM vocab v LEFT JOIN v_articles a ON {_mentions('v.term')}
GROUP BY v.term"""

_INDEX = f"""idx AS (SELECT v.term, a.title FROM vocab v JOIN v_articles a ON {_mentions('v.term')})"""


def _index_blocks_sql(block_size: int = INDEX_BLOCK_SIZE) -> str:
    run = max(1, block_size // 16)  # copies of a title that go by one hash
    return with_(V_ARTICLES, vocab_cte(ARTICLE_VOCAB), _INDEX,
                 f"r AS (SELECT term, title, (row_number() OVER (PARTITION BY term, title) - 1) // {run} AS run FROM idx)",
                 """h AS (SELECT term, title, ('0x' || substr(md5(title || CASE WHEN run > 0 THEN '#' || run ELSE '' END),
                           1, 8))::BIGINT AS hash FROM r)""",
                 "tot AS (SELECT term, count(*) AS n_term FROM h GROUP BY term)",
                 f"""b AS (SELECT h.term, (h.hash * CAST(ceil(tot.n_term / {block_size}) AS BIGINT)) >> 32
                           AS block, h.title FROM h JOIN tot ON h.term = tot.term)""") + """
SELECT term, block, count(*) AS n, string_agg(title, ',' ORDER BY title) AS titles
FROM b GROUP BY term, block
UNION ALL
SELECT term, 0, 0, '' FROM vocab WHERE term NOT IN (SELECT term FROM tot)"""


_DELIM = "instr(line, '</title><text>')"

ARTICLE_SQL = {
    "parse_articles": with_(V_ARTICLE_LINES) + f"""SELECT substr(line, 15, {_DELIM} - 15) AS title,
       substr(line, {_DELIM} + 14, length(line) - 16 - ({_DELIM} + 14) + 1) AS text
FROM v_article_lines""",
    "mentions_filter": with_(V_ARTICLES)
        + f"SELECT title FROM v_articles a WHERE {_mentions(repr(MENTION_TERM))}",
    "occurrences_of_term": with_(V_ARTICLES)
        + f"SELECT count(*) FILTER (WHERE {_mentions(repr(MENTION_TERM))}) AS n FROM v_articles a",
    "rank_terms": _RANK,
    "rank_terms_agg": _RANK,
    "rank_terms_using_index": _RANK,
    "inverted_index": with_(V_ARTICLES, vocab_cte(ARTICLE_VOCAB), _INDEX) + "SELECT term, title FROM idx",
    "inverted_index_arrays": _index_blocks_sql(),
    "top_term": _ART + f"""SELECT v.term, count(a.title) AS n
FROM vocab v LEFT JOIN v_articles a ON {_mentions('v.term')}
GROUP BY v.idx, v.term ORDER BY n DESC, v.idx LIMIT 1""",
}


# --- postings -------------------------------------------------------------

_POST = with_(V_POSTINGS, V_SCORED, v_vectors(SPREAD))

POSTING_SQL = {
    "parse_postings": with_(V_POSTINGS, V_POSTING_LINES) + """SELECT CAST(s[1] AS INT) AS posting_type,
       CAST(s[2] AS BIGINT) AS id, CAST(nullif(s[3], '') AS BIGINT) AS accepted_answer,
       CAST(nullif(s[4], '') AS BIGINT) AS parent_id, CAST(s[5] AS INT) AS score, nullif(s[6], '') AS tag
FROM (SELECT string_split(line, ',') AS s FROM v_posting_lines) t""",
    "grouped_posting_blocks": with_(
        V_POSTINGS,
        f"""r AS (SELECT parent_id AS qid, id, score,
              (row_number() OVER (PARTITION BY parent_id, id, score) - 1) // {ANSWER_BLOCK_SIZE} AS run
              FROM v_postings WHERE posting_type = 2 AND parent_id IN (SELECT id FROM v_postings WHERE posting_type = 1))""",
        f"""b AS (SELECT *, (('0x' || substr(md5(concat_ws(':', id, score, run)), 1, 8))::BIGINT
              * CAST(ceil(count(*) OVER (PARTITION BY qid) / {ANSWER_BLOCK_SIZE}) AS BIGINT)) >> 32 AS block,
              count(*) OVER (PARTITION BY qid) AS n_answers FROM r)""") + """SELECT qid, block, count(*) AS n, any_value(n_answers) AS n_answers,
       string_agg(concat_ws(':', id, score), ',' ORDER BY id, score) AS answers
FROM b GROUP BY qid, block""",
    "grouped_postings": """SELECT o_orderkey AS qid, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS tag,
       l_orderkey * 10 + l_linenumber AS answer_id, CAST(floor(l_extendedprice / 100) AS INT) - 300 AS score
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "weighted_medians": """WITH lines AS (
  SELECT l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS w FROM lineitem),
runs AS (
  SELECT l_suppkey, cents, sum(w) OVER (PARTITION BY l_suppkey ORDER BY cents) AS upto,
         sum(w) OVER (PARTITION BY l_suppkey) AS n FROM lines WHERE w > 0),
middles AS (
  SELECT l_suppkey, min(cents) FILTER (WHERE upto >= (n + 1) // 2) AS a, min(cents) FILTER (WHERE upto >= n // 2 + 1) AS b
  FROM runs GROUP BY l_suppkey)
SELECT l_suppkey, CAST(floor((a + b) / 2) AS BIGINT) AS median FROM middles""",
    "scored_postings": with_(V_POSTINGS, V_SCORED) + "SELECT id, tag, high_score FROM v_scored",
    "vector_postings": _POST + "SELECT x, y FROM v_vectors",
    "vector_count": _POST + "SELECT count(*) AS n FROM v_vectors",
    "distinct_vectors": _POST + "SELECT DISTINCT x, y FROM v_vectors",
}


# --- clustering -----------------------------------------------------------

def _label_case(spread: int, vocab: list[str] = POSTING_VOCAB) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(vocab))
    return f"CASE x // {spread} {whens} END"


def _assign_to(centers: str) -> str:
    return f"""asg AS (SELECT pw.x, pw.y, pw.w, c.center_id,
         row_number() OVER (PARTITION BY pw.x, pw.y
           ORDER BY (pw.x-c.x)*(pw.x-c.x) + (pw.y-c.y)*(pw.y-c.y), c.center_id) AS rn
  FROM pw CROSS JOIN {centers} c),
a AS (SELECT x, y, w, center_id FROM asg WHERE rn = 1)"""


_PW = "pw AS (SELECT x, y, count(*) AS w FROM v_vectors GROUP BY x, y)"


def _cluster_sql(spread: int, centers_cte: str, v_postings: str = V_POSTINGS, vocab: list[str] = POSTING_VOCAB) -> str:
    return with_(v_postings, V_SCORED, v_vectors(spread, vocab=vocab), centers_cte, kmeans_cte(ETA, MAX_ITERATIONS),
                 _assign_to("final"),
                 "lab AS (SELECT center_id, x, sum(w) AS n FROM a GROUP BY center_id, x)",
                 """top AS (SELECT center_id, x, n, sum(n) OVER (PARTITION BY center_id) AS size,
                   row_number() OVER (PARTITION BY center_id ORDER BY n DESC, x) AS r FROM lab)""",
                 """med AS (SELECT a.center_id, CAST(floor(quantile_cont(v.y, 0.5)) AS BIGINT) AS median
                   FROM a JOIN v_vectors v ON v.x = a.x AND v.y = a.y GROUP BY a.center_id)""",
                 f"""res AS (SELECT top.center_id, {_label_case(spread, vocab)} AS label,
                   CAST(100.0 AS DOUBLE) * n / size AS percent, CAST(size AS BIGINT) AS size, med.median
                   FROM top JOIN med ON top.center_id = med.center_id WHERE r = 1)""",
                 recursive=True)


_PER_TAG_CENTERS = v_centers(KERNELS // len(POSTING_VOCAB), SEED)
_GLOBAL_CENTERS = v_centers_global(KERNELS, SEED)
_KM = with_(V_POSTINGS, V_SCORED, v_vectors(SPREAD), _PER_TAG_CENTERS, kmeans_cte(ETA, MAX_ITERATIONS),
            recursive=True)

CLUSTER_SQL = {
    "sample_vectors": _POST.rstrip("\n") + ",\n" + _PER_TAG_CENTERS + "\nSELECT center_id, x, y FROM v_centers",
    "sample_vectors_global": _POST + f"""SELECT x, y FROM (SELECT DISTINCT x, y FROM v_vectors) d
ORDER BY md5(concat_ws(':', x, y, {SEED})), x, y LIMIT {KERNELS}""",
    "kmeans_assign": with_(V_POSTINGS, V_SCORED, v_vectors(SPREAD), _PER_TAG_CENTERS, _PW, _assign_to("v_centers"))
        + "SELECT center_id, CAST(sum(w) AS BIGINT) AS n FROM a GROUP BY center_id",
    "kmeans_step": with_(V_POSTINGS, V_SCORED, v_vectors(SPREAD), _PER_TAG_CENTERS, _PW, _assign_to("v_centers"),
                         """n AS (SELECT center_id, CAST(sum(x*w) // sum(w) AS BIGINT) AS x,
                                   CAST(sum(y*w) // sum(w) AS BIGINT) AS y FROM a GROUP BY center_id)""")
        + """SELECT c.center_id, coalesce(n.x, c.x) AS x, coalesce(n.y, c.y) AS y
FROM v_centers c LEFT JOIN n ON c.center_id = n.center_id""",
    "kmeans": _KM + "SELECT center_id, x, y FROM final",
    "kmeans_trace": _KM + "SELECT DISTINCT it AS iteration, moved FROM km WHERE it > 0",
    "cluster_results": _cluster_sql(SPREAD, _PER_TAG_CENTERS)
        + "SELECT center_id, label, percent, size, median FROM res",
    "cluster_report": _cluster_sql(SPREAD, _PER_TAG_CENTERS)
        + "SELECT printf('%7d  %-17s (%-5.1f%%)      %7d', median, label, percent, size) AS line FROM res",
    "cluster_results_mixed": _cluster_sql(MIXED_SPREAD, _GLOBAL_CENTERS)
        + "SELECT center_id, label, percent, size, median FROM res",
}

_PARSED_ARTICLES = f"""v_articles AS (
  SELECT substr(line, 15, {_DELIM} - 15) AS title,
         substr(line, {_DELIM} + 14, length(line) - 16 - ({_DELIM} + 14) + 1) AS text
  FROM v_article_lines)"""

_PARSED_POSTINGS = """v_postings AS (
  SELECT CAST(s[1] AS INT) AS posting_type, CAST(s[2] AS BIGINT) AS id,
         CAST(nullif(s[3], '') AS BIGINT) AS accepted_answer, CAST(nullif(s[4], '') AS BIGINT) AS parent_id,
         CAST(s[5] AS INT) AS score, nullif(s[6], '') AS tag
  FROM (SELECT string_split(line, ',') AS s FROM v_posting_lines) t)"""

ARTICLE_SQL["rank_terms_from_lines"] = with_(V_ARTICLE_LINES, _PARSED_ARTICLES, vocab_cte(ARTICLE_VOCAB)) + f"""SELECT v.term, count(a.title) AS n
FROM vocab v LEFT JOIN v_articles a ON {_mentions('v.term')}
GROUP BY v.term"""

POSTING_SQL["scored_postings_from_lines"] = (
    with_(V_POSTINGS.replace("v_postings AS", "v_raw AS"),
          V_POSTING_LINES.replace("FROM v_postings", "FROM v_raw"), _PARSED_POSTINGS, V_SCORED)
    + "SELECT id, tag, high_score FROM v_scored")

_KM_MIXED = with_(V_POSTINGS, V_SCORED, v_vectors(MIXED_SPREAD), _GLOBAL_CENTERS, kmeans_cte(ETA, MAX_ITERATIONS),
                  recursive=True)
CLUSTER_SQL["kmeans_45"] = with_(
    V_POSTINGS, V_SCORED, v_vectors(SPREAD, vocab=ALL_TAGS), v_centers(ALL_KERNELS // len(ALL_TAGS), SEED),
    kmeans_cte(ETA, MAX_ITERATIONS), recursive=True) + "SELECT center_id, x, y FROM final"
CLUSTER_SQL["kmeans_uncompacted"] = CLUSTER_SQL["kmeans"]
CLUSTER_SQL["kmeans_mixed"] = _KM_MIXED + "SELECT center_id, x, y FROM final"
CLUSTER_SQL["kmeans_trace_centers"] = _KM + """SELECT b.it AS iteration, b.i AS center_id, a.x, a.y,
       b.x AS new_x, b.y AS new_y, CAST((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) AS DOUBLE) AS moved
FROM km a JOIN km b ON a.i = b.i AND b.it = a.it + 1"""

V_PAIR_POSTINGS = V_POSTINGS.replace("THEN o_orderpriority END", "THEN concat_ws('/', o_orderpriority, o_orderstatus) END")
_PAIR_CENTERS = v_centers(PAIR_KERNELS // len(PAIR_TAGS), SEED)
CLUSTER_SQL["kmeans_15_tags"] = with_(
    V_PAIR_POSTINGS, V_SCORED, v_vectors(SPREAD, vocab=PAIR_TAGS), _PAIR_CENTERS,
    kmeans_cte(ETA, MAX_ITERATIONS), recursive=True) + "SELECT center_id, x, y FROM final"
CLUSTER_SQL["cluster_results_15_tags"] = (_cluster_sql(SPREAD, _PAIR_CENTERS, V_PAIR_POSTINGS, PAIR_TAGS)
                                          + "SELECT center_id, label, percent, size, median FROM res")
CLUSTER_SQL["kmeans_assign_many"] = with_(
    V_POSTINGS, V_SCORED, v_vectors(SPREAD, vocab=ALL_TAGS), v_centers_global(MANY_KERNELS, SEED), _PW,
    _assign_to("v_centers")) + "SELECT center_id, CAST(sum(w) AS BIGINT) AS n FROM a GROUP BY center_id"
ARTICLE_SQL["rank_terms_bitmaps"] = ARTICLE_SQL["stored_index_rank"] = _RANK
ARTICLE_SQL["index_bitmaps"] = ARTICLE_SQL["inverted_index"]
ARTICLE_SQL["rank_terms_vocab_table"] = with_(V_ARTICLES) + """SELECT term, count(*) AS n
FROM (SELECT unnest(list_distinct(string_split(text, ' '))) AS term FROM v_articles) WHERE term <> '' GROUP BY term"""
ARTICLE_SQL["stored_index_lookup"] = with_(V_ARTICLES, vocab_cte(STORED_TERMS), _INDEX) + "SELECT term, title FROM idx"
POSTING_SQL["scored_postings_bucketed"] = POSTING_SQL["scored_postings"]
SQL["time_usage_from_csv"] = SQL["time_usage_grouped"]

SQL.update(ARTICLE_SQL)
SQL.update(POSTING_SQL)
SQL.update(CLUSTER_SQL)
