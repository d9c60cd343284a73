"""The registered queries of this subpackage and their oracle SQL.

Each ``opN_`` query applies one operator, with its production parameters, to
every row of its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tumbleweed.llm import alignment, ann, chat, lexical, licenses, neardup, packing, pieces, quality, secrets, standin, topk, urls, wrappers
from tumbleweed.llm.common import table
from tumbleweed.session import scratch_path


def op1_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every embedding whose id is divisible by 20, by inner product."""
    return ann.search(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best integer inner products of every embedding whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.z::DOUBLE[], c.z::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and prediction of every document; learned from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every whole text, seeded by doc_id, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.decode(pieces.encode(docs))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle-set size and component of every document; two-word shingles, similarity 0.8."""
    return neardup.link_components(table(spark, sf_dir, "documents"), ngram=2, percent=80)



def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets found in every document: place, length, digest and the forest's probability."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.trained(docs, standin.labelled_findings(docs)))
    return found.where("is_secret").select("doc_id", F.col("start").cast("long").alias("start"), F.length("candidate").cast("long").alias("length"),
                                           F.sha2("candidate", 256).alias("secret_sha256"), "probability")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every segment of every document, in byte tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


#: The rules of the URL query: fixed values of its contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page; a page that no rule fits is allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, rules).drop("url")


OP8_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cutup AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
parts AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cutup),
pairs AS (SELECT DISTINCT host, path FROM parts),
fits AS (SELECT p.host, p.path, r.host || r.path AS rule, r.verdict,
                row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
         FROM pairs p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path AND f.n = 1
"""

#: The added conversation of the chat query: a fixed value of its contract.
CHAT_PROBE = r"\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, read back from the formatted strings, of every conversation and of conversation -7."""
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", CHAT_PROBE), (-7, 1, "assistant", CHAT_PROBE)],
                                  "conv_id long, turn long, role string, text string")
    done = chat.format_chats(standin.chat_records(convs.unionByName(probe)))
    back = chat.read_turns(F.col("formatted"))
    learned = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    lines = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (done.withColumn("back", back).withColumn("learned", learned)
            .select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


OP9_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + 2
           + length(regexp_replace(text, '[\\#<:]', 'xx', 'g')) + 9)::BIGINT AS formatted_chars
FROM rows_ GROUP BY conv_id
"""

def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in every document, with containment and the first word of the best window."""
    templates = spark.createDataFrame(licenses.TEMPLATES, "license string, text string")
    return licenses.scan(table(spark, sf_dir, "documents"), templates)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
stats AS (SELECT count(*)::BIGINT AS N, sum(len(terms))::BIGINT AS L FROM d WHERE len(terms) > 0),
tf AS (SELECT row_id, doc_id, term, count(*)::BIGINT AS tf FROM (SELECT row_id, doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, stats GROUP BY term, N),
m AS (SELECT row_id, 100 - 90 + (90 * len(terms)::BIGINT * N) // L AS m FROM d, stats WHERE len(terms) > 0),
scored AS (SELECT i.item_id, tf.doc_id, tf.row_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
           FROM i JOIN tf ON i.term = tf.term JOIN w ON w.term = tf.term JOIN m ON m.row_id = tf.row_id
           WHERE tf.doc_id IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizations of every text, with the corpus-wide counts of the linked ids."""
    done = alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    path = scratch_path(spark, "aligned")
    (done.withColumn("groups_sha256", digest).drop("groups").withColumn("row_id", F.monotonically_increasing_id())
     .write.parquet(path))
    aligned = spark.read.parquet(path)
    return alignment.count_links(aligned, alignment.link_counts(aligned), "row_id").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_ann_search": op1_ann_search,
    "op2_topk_search": op2_topk_search,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_near_dup": op5_near_dup,
    "op6_secret_scan": op6_secret_scan,
    "op7_packing": op7_packing,
    "op8_url_filter": op8_url_filter,
    "op9_chat_format": op9_chat_format,
    "op10_license_scan": op10_license_scan,
    "op11_lexical_search": op11_lexical_search,
    "op12_html_text": op12_html_text,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op2_topk_search": OP2_SQL,
    "op8_url_filter": OP8_SQL,
    "op9_chat_format": OP9_SQL,
    "op11_lexical_search": OP11_SQL,
}
