"""The operators on the given tables, as registered queries, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gridjoin, licences, minhash, packing, pieces, quality, quoting, resampling, substring, toxicity, vptree, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op2_nnls_packing(spark, sf_dir):
    import public_tokenizers

    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@registered
def op6_sentencepiece_merge_rounds(spark, sf_dir):
    import public_tokenizers

    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@registered
def op8_quality_classifier(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op5_substring_dedup(spark, sf_dir):
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


@registered
def op9_licence_scan(spark, sf_dir):
    return licences.scanned(table(spark, sf_dir, "documents"))


@registered
def op7_warc_index(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@registered
def op3_epsilon_grid_join(spark, sf_dir):
    return gridjoin.near_vectors(table(spark, sf_dir, "embeddings"))


@registered
def op4_vantage_point_search(spark, sf_dir):
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def quoting_messages(turns: DataFrame) -> DataFrame:
    """The given turns quote nothing: each is made to quote the one before it in full, and the first line of the one before that.

    Turns with a line that starts like a quote are left as they are.
    """
    before = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    one = before.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("said").alias("one"))
    two = before.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("said").alias("two"))

    def quoted(text: str, mark: str):
        return F.concat(F.lit(mark), F.regexp_replace(text, "\n", "\n" + mark), F.lit("\n"))

    joined = turns.join(one, ["conv_id", "turn"], "left").join(two, ["conv_id", "turn"], "left")
    first_line = F.concat(F.lit("> > "), F.split("two", "\n")[0], F.lit("\n"))
    head = F.when(F.col("one").isNotNull(), F.concat(F.lit("On an earlier turn they wrote:\n"), F.coalesce(first_line, F.lit("")), quoted("one", "> ")))
    return joined.select("conv_id", "turn", "role", F.concat(F.coalesce(head, F.lit("")), F.coalesce("text", F.lit(""))).alias("text"))


SQL["op10_quotation_linking"] = """
with recursive said as (select conv_id, turn, min(text) as said from conversations group by conv_id, turn),
linked as (
  select s.conv_id, s.turn,
    case when trim(one.said, E' \\t\\r\\n') <> '' then s.turn - 1
      when one.said is not null and trim(split_part(two.said, E'\\n', 1), E' \\t\\r\\n') <> '' then s.turn - 2 end as reply_to
  from said s left join said one on one.conv_id = s.conv_id and one.turn = s.turn - 1
    left join said two on two.conv_id = s.conv_id and two.turn = s.turn - 2),
runs as (
  select conv_id, turn, reply_to, turn as root, turn - turn as depth from linked where reply_to is null
  union all select l.conv_id, l.turn, l.reply_to, r.root, r.depth + 1 from linked l join runs r on r.conv_id = l.conv_id and r.turn = l.reply_to)
select c.conv_id, c.turn, c.role, r.reply_to, r.root, r.depth, coalesce(c.text, '') as text
from conversations c left join runs r on r.conv_id = c.conv_id and r.turn = c.turn"""


@registered
def op10_quotation_linking(spark, sf_dir):
    return quoting.conversations(quoting_messages(table(spark, sf_dir, "conversations")))


@registered
def op11_feast_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


SQL["op12_importance_resampling"] = """
with table_of_crc as (
  select list(c order by i) as crc_of from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) as c
    from range(256) r(i))),
texts as (
  select 'documents' as side, row_number() over () as place, doc_id, text from documents
  union all select 'benchmark', row_number() over (), null, text from benchmark),
words as (
  select side, place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word from texts),
vocabulary as (select distinct word, hex(encode(word)) as digits from words),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(digits)::bigint, 2), lambda i: ('0x' || substr(digits, i, 2))::bigint)),
    lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from vocabulary, table_of_crc),
counted as (select side, place, bucket, count(*) as n from words join hashed using (word) group by all),
totals as (select coalesce(sum(n) filter (side = 'documents'), 0) as s, coalesce(sum(n) filter (side = 'benchmark'), 0) as t from counted),
gains as (
  select bucket, floor(1000 * ln((coalesce(sum(n) filter (side = 'benchmark'), 0) + 1)::double * (any_value(totals.s) + 10000)::double
    / ((coalesce(sum(n) filter (side = 'documents'), 0) + 1)::double * (any_value(totals.t) + 10000)::double)))::bigint as gain
  from counted, totals group by bucket),
weighed as (
  select place, sum(n) as n_features, sum(n * gain) as total from counted join gains using (bucket) where side = 'documents' group by place),
scored as (
  select t.place, t.doc_id, coalesce(n_features, 0)::bigint as n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::bigint as weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(t.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as noise
  from texts t left join weighed w using (place) where t.side = 'documents'),
ranked as (
  select place, row_number() over (order by weight + noise desc, doc_id nulls last) as rank, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, weight + noise as score, case when rank <= n * 10 // 100 then rank end as rank
from scored left join ranked using (place)"""


@registered
def op12_importance_resampling(spark, sf_dir):
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op13_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
