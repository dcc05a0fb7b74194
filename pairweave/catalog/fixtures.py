"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairweave.functions.arrays import BOS, EOS, UNK, add_specials
from pairweave.functions.text import normalize_text, pretokenize
from pairweave.operators.vocabulary import Bpe, id_lookup, lookup_ids, train_bpe, unit_counts, word_vocabulary
from pairweave.plans.buckets import Plan, plan_buckets
from pairweave.plans.preprocess import piece_counts
from pairweave.session import cut_lineage, scratch_path, spread
from pairweave.sources.tables import read_vocab, write_vocab

NUM_CUTS = 8
MIN_SAMPLES = 200
MAX_SAMPLES = 1500
WORD_VOCABULARY = 2000
TOKEN_BUDGET = 2000
EPOCHS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def length_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and target lengths, one pair per line item."""
    source = F.col("l_quantity").cast("int") + 2
    target = F.greatest(F.lit(2).cast("bigint"), source + F.col("l_suppkey") % 7 - 3).cast("int")
    rows = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    return rows.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("pair_id"),
        source.alias("src_len"),
        target.alias("tgt_len"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` of all documents, over all cores."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def bucket_plan(spark: SparkSession, sf_dir: str) -> Plan:
    """Shard assignment over all length pairs."""
    return plan_buckets(length_pairs(spark, sf_dir), NUM_CUTS, MIN_SAMPLES, MAX_SAMPLES)


def bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn that follows it, by an equi join on unique turn keys."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("next"), F.concat_ws(":", "conv_id", "turn").alias("pair_id"),
        F.col("text").alias("src_text"),
    )
    answered = turns.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("next"), F.col("text").alias("tgt_text"))
    return asked.join(answered, ["conv_id", "next"]).select("pair_id", "src_text", "tgt_text")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pair_id, text)`` of every turn, whoever speaks; the ids are those of ``bitext``."""
    return spread(table(spark, sf_dir, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("pair_id"), "text"))


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a document with the line after it; made inside the row, without a shuffle."""
    lines = F.split("text", "\n")
    pairs = F.arrays_zip(
        F.slice(lines, F.lit(1), F.size(lines) - 1).alias("a"), F.slice(lines, F.lit(2), F.size(lines) - 1).alias("b")
    )
    each = documents(spark, sf_dir).select("doc_id", F.posexplode(pairs).alias("line_no", "p"))
    key = F.concat_ws(":", "doc_id", "line_no")
    return each.select(key.alias("pair_id"), F.col("p.a").alias("src_text"), F.col("p.b").alias("tgt_text"))


def nested_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs as the one struct column that raw files hold; an empty line counts as missing."""
    missing = lambda c: F.nullif(F.trim(c), F.lit(""))
    inner = F.struct(missing("src_text").alias("en"), missing("tgt_text").alias("zh"))
    return pairs.select("pair_id", inner.alias("translation"))


def word_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent pieces of all documents."""
    counts = piece_counts(documents(spark, sf_dir), "text")
    return cut_lineage(word_vocabulary(counts, WORD_VOCABULARY))


def _pieces(text: str):
    return pretokenize(normalize_text(F.col(text)))


def encoded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, ids)`` of every whole document with a word-level vocabulary."""
    docs = documents(spark, sf_dir).select("doc_id", _pieces("text").alias("pieces"))
    return lookup_ids(docs, "doc_id", "pieces", word_vocab(spark, sf_dir))


def encoded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line pairs as ids with markers: ``(pair_id, src_ids, tgt_ids)``; both sides in one pass, nothing shuffled."""
    look_up = id_lookup(word_vocab(spark, sf_dir))
    encoded = line_pairs(spark, sf_dir).select(
        "pair_id", look_up(_pieces("src_text")).alias("_src"), look_up(_pieces("tgt_text")).alias("_tgt")
    )
    return encoded.select("pair_id", add_specials(F.col("_src")).alias("src_ids"), add_specials(F.col("_tgt")).alias("tgt_ids"))


_MODELS: dict[tuple[str, str], str] = {}


def bpe_model(spark: SparkSession, sf_dir: str) -> Bpe:
    """The subword model of all documents, trained to the real stop: 16,384 tokens, or no pair that occurs four times.

    It is trained once per session and data set, saved, and loaded from then on.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    try:
        return read_vocab(spark, _MODELS[key])
    except (KeyError, FileNotFoundError):
        path = scratch(spark, "bpe")
        write_vocab(train_bpe(unit_counts(documents(spark, sf_dir), "text")), path)
        _MODELS[key] = path
        return read_vocab(spark, path)


def drop_every_fifth(text):
    """A sentence without every fifth word, as a stand-in for a translation."""
    words = F.split(text, " ")
    return F.array_join(F.filter(words, lambda w, i: (i + 1) % 5 != 0), " ")


def hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pair_id, src_text, ref_text, hyp_text)``."""
    return bitext(spark, sf_dir).select(
        "pair_id", "src_text", F.col("tgt_text").alias("ref_text"), drop_every_fifth(F.col("tgt_text")).alias("hyp_text")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document as labels, and the same with an unknown token in every fifth place."""
    labelled = encoded_documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("pair_id"), F.concat("ids", F.array(F.lit(EOS))).alias("labels"))
    number = F.length("pair_id")
    wrong = lambda y, i: F.when((number + i) % 5 == 0, F.lit(UNK)).otherwise(y)
    return labelled.withColumn("preds", F.transform("labels", wrong))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored continuations, one per event, grouped by user."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item_id"),
        (event % 4).cast("int").alias("beam"),
        event.cast("int").alias("token"),
        (-(event % 11)).cast("double").alias("score"),
        (F.lit(0.0) - F.col("value") / 100).alias("logp"),
        (1 + event % 30).cast("int").alias("len"),
        (event % 13 == 0).alias("finished"),
    )


FOLLOWERS = 16


def next_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(prev, token, logit)``: the tokens that follow each token of the word vocabulary most often in all documents."""
    ended = encoded_documents(spark, sf_dir).select(F.concat(F.array(F.lit(BOS)), "ids", F.array(F.lit(EOS))).alias("ids"))
    pairs = ended.select(F.explode(F.arrays_zip(F.slice("ids", F.lit(1), F.size("ids") - 1).alias("prev"), F.slice("ids", F.lit(2), F.size("ids") - 1).alias("token"))).alias("p"))
    counts = pairs.groupBy("p.prev", "p.token").agg(F.count(F.lit(1)).alias("cnt"))
    place = F.row_number().over(Window.partitionBy("prev").orderBy(F.desc("cnt"), "token"))  # a vocabulary at most
    top = counts.withColumn("place", place).filter(F.col("place") <= FOLLOWERS)
    return cut_lineage(top.select("prev", "token", F.round(F.log("cnt"), 9).alias("logit")))


def write_file_per_part(rows: DataFrame, folder: str) -> None:
    """One file in ``part=...`` for each value of ``part``; rows are streamed into it, where a partitioned write would sort all of a file's first."""
    for value in sorted(r.part for r in rows.select("part").distinct().collect()):
        rows.filter(F.col("part") == value).drop("part").repartition(1).write.parquet(f"{folder}/part={value}")


def break_file(spark: SparkSession, folder: str, keep: list[tuple[float, int, float, int]]) -> None:
    """Replace the one data file of a folder by stretches of itself, each from and to a share of its length and an offset."""
    hadoop = spark._jvm.org.apache.hadoop
    location = hadoop.fs.Path(folder)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    (whole,) = [e for e in fs.listStatus(location) if e.getPath().getName().startswith("part-")]
    size, broken = whole.getLen(), hadoop.fs.Path(folder, "broken.parquet")
    out = fs.create(broken, True)
    for low_share, low, high_share, high in keep:
        start, end = int(size * low_share) + low, int(size * high_share) + high
        stream = fs.open(whole.getPath())
        spark._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, start, end - start)
        stream.close()
    out.close()
    fs.delete(whole.getPath(), False)


def token_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as the logits of one token; eight tokens make a sentence and eight sentences a batch."""
    vec = F.col("vec_id")
    label = F.when(vec % 7 == 0, 0).otherwise(vec % F.size("embedding")).cast("int")
    return table(spark, sf_dir, "embeddings").select(
        F.floor(vec / 64).alias("batch_id"), F.floor(vec / 8).alias("row_id"), F.col("embedding").alias("logits"), label.alias("label")
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for a query that writes and reads back."""
    return scratch_path(spark, name)
