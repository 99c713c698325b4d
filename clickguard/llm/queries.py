"""The registered queries of this subpackage, opN_<name> per operator: each
runs its operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.llm import (
    decontaminate,
    embedding,
    lexical,
    licenses,
    neighbours,
    pieces,
    preference,
    quality,
    runs,
    simhash,
    substring,
    urls,
    warc,
)
from clickguard.llm.common import read_table


#: A public tokenizer's model on the driver's disk; its path is a parameter
#: of the operator.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again and compared."""
    return pieces.encode(read_table(spark, sf_dir, "documents"), MODEL, check=True)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     q AS (SELECT page_id, h, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM q
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document: 4-word
    shingles, links at 4 or fewer bits."""
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


def op4_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct links at a cosine of 0.95 or more and the component of every
    vector."""
    return embedding.embedding_duplicates(read_table(spark, sf_dir, "embeddings"))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations: the conversation against itself
    with the last reply replaced by the one before, as rows of prompt, chosen and
    rejected turns with loss spans; without a reply it is all prompt."""
    chosen, rejected = preference.last_reply_pairs(read_table(spark, sf_dir, "conversations"))
    return preference.format_preferences(chosen, rejected)


OP5_SQL = """
WITH replies AS (SELECT conv_id, turn, min(text) AS text FROM conversations
                 WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id, turn),
ends AS (SELECT conv_id, max(turn) AS last_turn FROM replies GROUP BY conv_id),
prior AS (SELECT r.conv_id, arg_max(r.text, r.turn) AS prior_text
          FROM replies r JOIN ends e ON r.conv_id = e.conv_id AND r.turn < e.last_turn GROUP BY r.conv_id),
both_sides AS (
  SELECT c.conv_id, c.turn, c.role, c.text,
         CASE WHEN c.role = 'assistant' AND c.turn = e.last_turn THEN coalesce(p.prior_text, '') ELSE c.text END AS other
  FROM conversations c LEFT JOIN ends e ON c.conv_id = e.conv_id LEFT JOIN prior p ON c.conv_id = p.conv_id),
one AS (SELECT conv_id, turn, role, text,
               row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS n FROM both_sides),
two AS (SELECT conv_id, turn, role, other AS text,
               row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, other) AS n FROM both_sides),
cut AS (SELECT one.conv_id, min(one.turn * 1000000 + one.n) AS first_place FROM one JOIN two USING (conv_id, turn, n)
        WHERE one.role IS DISTINCT FROM two.role OR one.text IS DISTINCT FROM two.text GROUP BY one.conv_id),
parts AS (
  SELECT one.*, CASE WHEN first_place IS NULL OR turn * 1000000 + n < first_place THEN 'prompt' ELSE 'chosen' END AS part
  FROM one LEFT JOIN cut USING (conv_id)
  UNION ALL SELECT two.*, 'rejected' FROM two JOIN cut USING (conv_id) WHERE turn * 1000000 + n >= first_place)
SELECT conv_id AS pair_id, part, turn, CAST(n AS INTEGER) AS n, role,
       '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
       CAST(length(role) + 5 AS INTEGER) AS loss_start,
       CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(text) ELSE 0 END AS INTEGER) AS loss_length
FROM parts
"""


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages that repeat from a document with a smaller id, one row
    per span: words word_start .. word_start + n_words - 1 of doc_id."""
    return substring.repeated_spans(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents at a weighted 5-word shingle
    similarity of 0.8 or more."""
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in documents, at a containment of 0.8 or more of
    their 5-word shingles."""
    return licenses.license_hits(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out ids are not learnt."""
    return quality.quality_scores(read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "labels"))


#: (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    rows = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(rows, rows.where("vec_id % 100 = 0"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item by the terms they share."""
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"),
                                 read_table(spark, sf_dir, "benchmark"))


OP12_SQL = """
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT doc_id, r, w, len(w) AS n FROM words WHERE len(w) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
item_words AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
asked AS (SELECT item_id, t, count(*) AS times FROM item_words GROUP BY item_id, t),
tfs AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs)
        WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS wt
            FROM tfs, totals GROUP BY t, nn),
impacts AS (
  SELECT d.doc_id, d.r, f.t,
         wt * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * d.n * nn) // ll))) AS impact
  FROM tfs f JOIN docs d USING (r) JOIN weights USING (t), totals),
scores AS (SELECT item_id, doc_id, r, CAST(sum(times * impact) AS BIGINT) AS score
           FROM impacts JOIN asked USING (t) GROUP BY item_id, doc_id, r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
           FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document's words; one document in ten is made
    to repeat itself first."""
    docs = read_table(spark, sf_dir, "documents")
    text = runs.looped(F.col("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return runs.run_digests(runs.periodic_runs(docs.select("doc_id", text.alias("text"))))


def queries():
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_warc": op2_warc,
        "op3_simhash": op3_simhash,
        "op4_embedding": op4_embedding,
        "op5_preference": op5_preference,
        "op6_substring": op6_substring,
        "op7_decontaminate": op7_decontaminate,
        "op8_licenses": op8_licenses,
        "op9_quality": op9_quality,
        "op10_urls": op10_urls,
        "op11_neighbours": op11_neighbours,
        "op12_lexical": op12_lexical,
        "op13_runs": op13_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op5_preference": OP5_SQL, "op12_lexical": OP12_SQL}
