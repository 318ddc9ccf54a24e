"""The operators as registered queries, over the whole of their tables."""

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    conversations,
    embedding_dedup,
    hard_negatives,
    html_text,
    jaccard_join,
    license_scan,
    mixing,
    packing,
    periodic_runs,
    quality,
    token_files,
    topk,
    url_filter,
)
from feedlake.llm.frames import WORD, table
from feedlake.llm.tokens import default_vocabulary
from feedlake.workspace import work_folder

#: Fixed by the contract of the queries.
TOKEN_FILE_END_ID = 2
SEQUENCE_END_ID = 1
SEQUENCE_LENGTH = 4096


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "tokens")
    manifest = token_files.write_token_files(
        documents, folder, default_vocabulary(), TOKEN_FILE_END_ID
    )
    return token_files.token_positions(manifest)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    similarity = jaccard_join.Similarity(words=3, num=90, den=100)
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), similarity)


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.rendered(table(spark, sf_dir, "conversations"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return topk.top_k(embeddings, F.col("vec_id") % 20 == 0, k=20, factor=64)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.classify(documents, table(spark, sf_dir, "labels"), columns=["doc_id"])
    return judged.select("doc_id", "held_out", "score", "predicted")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), default_vocabulary(), SEQUENCE_END_ID, SEQUENCE_LENGTH
    )
    return packed.drop("copy")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    n_chars = F.length("text").cast("long").alias("n_chars")
    return pages.select("page_id", "url", "text", n_chars)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("times")).alias("taken")
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", taken)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(embeddings, F.col("vec_id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _with_periods(documents: DataFrame) -> DataFrame:
    """Of every tenth document by hash, the words from some place on become a periodic run."""
    split = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    hashed = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    marked = hashed.withColumn("words", F.when(F.col("h") % 10 == 0, split))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    placed = marked.withColumns({"n": n, "a": a})
    rest = F.col("n") - F.col("a")
    period = (1 + F.floor(rest / (3 + g % 8))).cast("int")
    placed = placed.withColumn("p", period)
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int")))
    made = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), rest))
    text = F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(_with_periods(documents))
    by_length = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    length, period = -F.col("longest.col1"), F.col("longest.period")
    listed = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))
    )
    return found.withColumn("longest", F.array_min(by_length)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it.

    On a cluster where it is installed, or sent with --py-files, the path does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        paths = [root, *filter(None, paths)]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(paths)


def _ready(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return query(spark, sf_dir)

    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_token_files": op1_token_files,
        "op2_url_filter": op2_url_filter,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_chat_formatting": op4_chat_formatting,
        "op5_exact_top_k": op5_exact_top_k,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_html_extraction": op9_html_extraction,
        "op10_source_mix": op10_source_mix,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_license_scan": op12_license_scan,
        "op13_periodic_runs": op13_periodic_runs,
    }
    return {name: _ready(query) for name, query in found.items()}


def _ratio_steps() -> str:
    """SQL of the estimates for every length of context, each on the one before."""
    steps = []
    for order in range(4):
        less = "1.0 / (SELECT count(DISTINCT right(gram, 1)) FROM counts)"
        joined = ""
        if order:
            joined = f"JOIN share{order - 1} AS l ON l.g = substr(s.g, 2)"
        seen = f"""
seen{order} AS (
    SELECT right(gram, {order + 1}) AS g, sum(allowed) AS allowed, sum(blocked) AS blocked
    FROM counts GROUP BY 1
), context{order} AS (
    SELECT left(g, {order}) AS context,
           sum(allowed) AS an, count(*) FILTER (allowed > 0) AS ak,
           sum(blocked) AS bn, count(*) FILTER (blocked > 0) AS bk
    FROM seen{order} GROUP BY 1
), share{order} AS (
    SELECT s.g,
           CASE WHEN an > 0 THEN (s.allowed + ak * {"l.a" if order else less}) / (an + ak)
                ELSE {"l.a" if order else less} END AS a,
           CASE WHEN bn > 0 THEN (s.blocked + bk * {"l.b" if order else less}) / (bn + bk)
                ELSE {"l.b" if order else less} END AS b
    FROM seen{order} AS s JOIN context{order} ON context = left(s.g, {order}) {joined}
)"""
        steps.append(seen)
    return ",".join(steps)


OP2_SQL = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://')
                         THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM pages
), parted AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), lowered AS (
    SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host
    FROM parted
), rules(says, domain, start) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
           ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
    SELECT p.page_id, p.host, p.path, p.host || p.path AS text,
           (SELECT max_by(domain || start, length(domain || start)) FROM rules
            WHERE (p.host = domain OR ends_with(p.host, '.' || domain))
              AND starts_with(p.path, start)) AS rule,
           (SELECT max_by(says, length(domain || start)) FROM rules
            WHERE (p.host = domain OR ends_with(p.host, '.' || domain))
              AND starts_with(p.path, start)) AS verdict
    FROM lowered AS p
), texts AS (
    SELECT text, count(*) FILTER (verdict = 'allow') AS allowed,
           count(*) FILTER (verdict = 'block') AS blocked,
           left(md5(text), 1) IN ('0', '1', '2') AS calibrates
    FROM judged GROUP BY text
), grams AS (
    SELECT t.*, substr(repeat(chr(2), 3) || text || chr(3), CAST(place AS INTEGER), 4) AS gram
    FROM texts AS t, unnest(range(1, length(text) + 2)) AS places(place)
), counts AS (
    SELECT gram, sum(CASE WHEN calibrates THEN 0 ELSE allowed END) AS allowed,
           sum(CASE WHEN calibrates THEN 0 ELSE blocked END) AS blocked
    FROM grams GROUP BY gram
), {_ratio_steps()},
ratios AS (
    SELECT g AS gram,
           CASE WHEN (SELECT sum(allowed) > 0 AND sum(blocked) > 0 FROM counts)
                THEN ln(a) - ln(b) ELSE 0 END AS ratio
    FROM share3
), scored AS (
    SELECT text, any_value(allowed) AS allowed, any_value(blocked) AS blocked,
           any_value(calibrates) AS calibrates,
           CAST(sum(CAST(round(ratio * 1073741824) AS BIGINT)) AS DOUBLE) / 1073741824.0
               / count(*) AS score
    FROM grams JOIN ratios USING (gram) GROUP BY text
), steps AS (
    SELECT least(greatest(floor(score * 100), -1000), 1000) AS step,
           sum(allowed) AS a, sum(blocked) AS b
    FROM scored WHERE calibrates AND allowed + blocked > 0 GROUP BY 1
), passed AS (
    SELECT step, coalesce(lag(step) OVER (ORDER BY step) + 1, step) AS free,
           coalesce(sum(a) OVER below, 0) AS missed, coalesce(sum(b) OVER below, 0) AS caught,
           sum(a) OVER () AS a, sum(b) OVER () AS b
    FROM steps
    WINDOW below AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), best AS (
    SELECT (free + step) / 2 / 100 AS least FROM passed WHERE a > 0 AND b > 0
    ORDER BY caught * a - missed * b DESC, step LIMIT 1
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN score >= coalesce((SELECT least FROM best), 0)
                              THEN 'allow' ELSE 'block' END) AS verdict
FROM judged JOIN scored USING (text)
"""

_DOUBLES = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
#: No vector takes part that is null, empty, or holds null or non-finite components.
_SOUND = f"""
    embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter({_DOUBLES}, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

OP5_SQL = f"""
WITH vectors AS (
    SELECT vec_id, list_transform({_DOUBLES}, lambda x: floor(64 * x)) AS v
    FROM embeddings WHERE {_SOUND} AND vec_id IS NOT NULL
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP11_SQL = f"""
WITH vectors AS (
    SELECT row_number() OVER () AS row, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform({_DOUBLES}, lambda x: floor(256 * x)) AS v
    FROM embeddings WHERE {_SOUND} AND vec_id IS NOT NULL AND label IS NOT NULL
), scored AS (
    SELECT a.row, a.vec_id AS anchor_id, c.row AS other, c.vec_id, a.label = c.label AS alike,
           CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM vectors AS a JOIN vectors AS c ON a.row <> c.row AND len(a.v) = len(c.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.row, p.other ORDER BY n.score DESC, n.vec_id)
                AS INTEGER) AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives AS p JOIN scored AS n ON p.row = n.row AND NOT n.alike
    WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT * FROM ranked WHERE rank <= 10
"""



def _quoted(words: list[str]) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def _license_rows() -> tuple[str, str]:
    phrases = [f"('{label}', {_quoted(p.split())})" for p, label in license_scan.PHRASES.items()]
    sets = [(label, license_scan.template_words(text)) for label, text in license_scan.TEMPLATES]
    return ", ".join(phrases), ", ".join(f"('{label}', {_quoted(words)})" for label, words in sets)


#: Every block against every template.
OP12_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), phrases(label, phrase) AS (
    VALUES {phrases}
), templates(label, wanted) AS (
    VALUES {templates}
), places AS (
    SELECT row, place - 1 AS place, label
    FROM texts, unnest(range(1, len(words) + 1)) AS places(place), phrases
    WHERE words[place] = phrase[1] AND words[place:place + len(phrase) - 1] = phrase
), base AS (
    SELECT row, count(*) AS n, min(place) AS first_word, max(place) AS last_word,
           list_distinct(list(label)) AS labels
    FROM places GROUP BY row
), blocks AS (
    SELECT row, words[64 * number + 1:64 * number + 128] AS held
    FROM texts, unnest(range(greatest(1, CAST(ceil(len(words) / 64.0) AS BIGINT) - 1))) AS b(number)
), shares AS (
    SELECT row, label, len(list_intersect(wanted, held)) AS shared, len(wanted) AS size
    FROM blocks, templates
), added AS (
    SELECT row, list_distinct(list(label)) AS labels,
           max(CAST(shared AS DOUBLE) / CAST(size AS DOUBLE)) AS share
    FROM shares WHERE 10 * shared >= 9 * size GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, a.labels))), ','), '')
           AS labels,
       greatest(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END, coalesce(share, 0.0))::DOUBLE AS score
FROM texts LEFT JOIN base AS b USING (row) LEFT JOIN added AS a USING (row)
""".format(**dict(zip(("phrases", "templates"), _license_rows())))

#: Prefixes are compared as whole texts here, not by hash.
OP4_SQL = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
           ) AS position,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM conversations
), begun AS (
    SELECT conv_id, position, n,
           string_agg(length(role) || ':' || length(text) || ':' || role || text, '|') OVER (
               PARTITION BY conv_id ORDER BY position
           ) AS said
    FROM turns
), kept AS (
    SELECT n, min(conv_id) AS conv_id
    FROM begun AS b
    WHERE position = n AND NOT EXISTS (
        SELECT 1 FROM begun AS l
        WHERE l.position < l.n AND l.position = b.n AND l.said = b.said
    )
    GROUP BY n, said
)
SELECT t.conv_id, CAST((position - 1) // 4096 AS INTEGER) AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                  ORDER BY position) AS text
FROM turns AS t JOIN kept AS k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY t.conv_id, part
"""

#: From links (a, b) between rows, the component of every row that has one: reached (a, b).
_REACHED = """
reached AS (
    SELECT a, b FROM both_ways
    UNION SELECT r.a, l.b FROM reached AS r JOIN both_ways AS l ON r.b = l.a
)"""

#: All pairs of texts that share a shingle.
OP3_SQL = rf"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT row, doc_id,
           CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                                  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
           END AS shingles
    FROM texts
), shingled AS (
    SELECT row, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT x.row AS a, y.row AS b
    FROM shingled AS x JOIN shingled AS y ON x.shingle = y.shingle AND x.row < y.row
    WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
    GROUP BY x.row, y.row, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), {_REACHED}, smallest AS (
    SELECT r.a AS row, min(s.doc_id) AS least FROM reached AS r JOIN sets AS s ON r.b = s.row GROUP BY r.a
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
       CASE WHEN least IS NULL THEN doc_id ELSE coalesce(least(least, doc_id), least) END AS component_id
FROM sets LEFT JOIN smallest USING (row)
"""

#: All pairs of vectors.
OP6_SQL = f"""
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS row, vec_id, {_DOUBLES} AS v, {_SOUND} AS sound FROM embeddings
), sound AS (
    SELECT row, v FROM vectors WHERE sound AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.row AS a, y.row AS b
    FROM sound AS x JOIN sound AS y ON x.row < y.row AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), {_REACHED}, smallest AS (
    SELECT r.a AS row, min(s.vec_id) AS least FROM reached AS r JOIN vectors AS s ON r.b = s.row GROUP BY r.a
), counted AS (
    SELECT a AS row, count(*) AS n FROM both_ways GROUP BY a
), named AS (
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
           CASE WHEN least IS NULL THEN vec_id ELSE coalesce(least(least, vec_id), least) END AS component_id
    FROM vectors LEFT JOIN smallest USING (row) LEFT JOIN counted USING (row)
)
SELECT *, coalesce(vec_id = component_id, false) AS kept FROM named
"""


def llm_oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": OP2_SQL,
        "op3_jaccard_join": OP3_SQL,
        "op4_chat_formatting": OP4_SQL,
        "op5_exact_top_k": OP5_SQL,
        "op6_embedding_dedup": OP6_SQL,
        "op11_hard_negatives": OP11_SQL,
        "op12_license_scan": OP12_SQL,
    }
