"""Mixing sources to target weights by a low-discrepancy schedule.

The words of a source are a stream: its documents in the order of a hash, again and again. The
stream is cut into blocks of equal token counts. The schedule of the mix is a row of slots: the
van der Corput point of slot i falls into one source's share of the cumulative weights, and the
r-th slot of a source takes block r of its stream. Slots beyond a source's quota are left out,
and the few slots that the points leave short (a logarithm of the slots at most) follow at the
end, so every source meets its target to the word while any stretch of the mix stays close to
the weights. Slots meet blocks in an equi-join, one block per slot; neither side has a hot key.

Streams, ranks and weights are running sums over hash buckets (``running_total``), so a source
with a third of all rows is never one task. One row per source is assumed to fit a task.

Defined cases: a null text has no words; a null source is a source, the last one; ids may be
null or repeat, every row is mixed on its own; a source without words takes nothing; an empty
table gives an empty mix; extra columns are ignored by ``mix`` and kept by ``mixed_documents``,
which numbers the rows, so that each follows its own take. Null ids share one place, as in ``OP2_SQL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procurelens.llm.common import WORD, bucket_bits, fresh, numbered, running_total, saved, table

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and so a document, is taken this often at most.
MOST_EPOCHS = 3
#: Words of a block.
BLOCK_WORDS = 512
#: Bits of a van der Corput point.
POINT_BITS = 40
#: Bits of the hash that orders the documents of a source.
ORDER_BITS = 48


def van_der_corput(i: Column, bits: int = POINT_BITS) -> Column:
    """The first ``bits`` bits of the base-2 van der Corput point of i, as a whole number."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, "0")), 2, 10).cast("long")


def document_sizes(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, source_col: str, row_col: str | None = None) -> DataFrame:
    """(doc_id, source, size, place, text_key, row): the words of each document and its place in the hash order."""
    place = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":mix"))), 1, 12), 16, 10)
    return saved(
        spark,
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            place.cast("long").alias("place"),
            F.xxhash64(text_col).alias("text_key"),
            (F.col(row_col) if row_col else F.lit(0).cast("long")).alias("row"),
        ),
        "sizes",
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: sid, source, source_size, target, quota (whole words).

    Targets share all words by weight; a source stops at ``most`` times its size, and what it
    leaves is shared again. Sources sorted by cap over weight fill up in that order, so the
    last level is the rest over the weights that are still open.
    """
    listed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int")
    listed = listed.withColumn("sid", nth).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1).cast("double")
    )
    listed = listed.withColumn("cap", F.col("source_size").cast("double") * most)
    filling = W.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    listed = (
        listed.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(filling), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    )
    room = (F.col("total") - F.col("capped_before")) * F.col("weight")
    listed = listed.withColumn("full", F.col("cap") * (F.col("weights") - F.col("weight_before")) <= room)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    level = rest / F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.round(F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight"))), 6)
    listed = listed.withColumn("target", target).withColumn("quota", F.floor(F.col("target") + 1e-6).cast("long"))
    return listed.select("sid", "source", "source_size", "target", "quota")


def schedule(spark: SparkSession, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, sid, rank): which block of which source comes at each place of the mix."""
    wanted = targets.withColumn("blocks", F.ceil(F.col("quota") / block_words).cast("long"))
    n_sources, n_slots = wanted.agg(F.count("*"), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    upto = F.sum("quota").over(W.orderBy("sid").rowsBetween(W.unboundedPreceding, 0))
    shares = wanted.withColumn("upto", upto).withColumn("all", F.sum("quota").over(W.partitionBy()))
    edge = lambda words: F.floor(words / F.col("all").cast("double") * float(1 << POINT_BITS)).cast("long")
    shares = shares.where("all > 0").select(
        "sid", "blocks", edge(F.col("upto") - F.col("quota")).alias("low"), edge(F.col("upto")).alias("high")
    )
    # Points meet shares in equal cells: the points spread evenly over them, so no cell is hot.
    cell_bits = min(20, (4 * n_sources).bit_length())
    shift = POINT_BITS - cell_bits
    cells = shares.where("low < high").withColumn(
        "cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift)))
    )
    points = spark.range(n_slots).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("point"))
    points = points.withColumn("cell", F.shiftright("point", shift))
    dealt = points.join(cells, "cell").where("point >= low AND point < high").select("slot", "sid", "blocks")
    dealt = dealt.withColumn("chunk", F.shiftright("slot", 10)).withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(dealt, ["sid"], "chunk", ["slot"], "one", "rank", bucket_bits(n_slots) // 2)
    used = ranked.where("rank < blocks").select("slot", "sid", "rank")
    have = used.groupBy("sid").agg(F.count("*").alias("have"))
    short = wanted.join(have, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < blocks")
    late = short.select("sid", F.explode(F.expr("sequence(have, blocks - 1)")).alias("rank"))
    late = late.withColumn("slot", F.lit(n_slots) + F.row_number().over(W.orderBy("rank", "sid")) - 1)
    return used.unionByName(late.select("slot", "sid", "rank"))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = BLOCK_WORDS,
    row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The placed documents and the pieces of the mix.

    Documents: doc_id, source, size, row (``row_col``), sid, source_size, target, quota, pos and the
    row key (sid, bucket, nth). Pieces: slot, epoch, the row key, first word and number of words.
    """
    sizes = document_sizes(spark, docs, id_col, text_col, source_col, row_col)
    targets = saved(spark, source_targets(sizes), "targets")
    bits = bucket_bits(sizes.count())
    same = F.col("source").eqNullSafe(F.col("_source"))
    rows = sizes.join(targets.withColumnRenamed("source", "_source"), same).drop("_source")
    rows = rows.withColumn("bucket", F.shiftright("place", ORDER_BITS - bits))
    order = ["place", "doc_id", "size", "text_key", "row"]
    rows = rows.withColumn("nth", F.row_number().over(W.partitionBy("sid", "bucket").orderBy(*order)))
    placed = saved(spark, running_total(rows, ["sid"], "bucket", ["nth"], "size", "pos", bits // 2), "placed")

    epochs = placed.where("size > 0 AND pos < quota").withColumn(
        "epoch", F.explode(F.expr("sequence(0L, (quota - 1 - pos) div source_size)"))
    )
    spans = epochs.withColumn("start", F.expr("epoch * source_size + pos")).withColumn(
        "stop", F.expr("least(start + size, quota)")
    )
    spans = spans.withColumn("rank", F.explode(F.expr(f"sequence(start div {block_words}, (stop - 1) div {block_words})")))
    pieces = spans.selectExpr(
        "sid", "bucket", "nth", "epoch", "rank",
        f"greatest(start, rank * {block_words}) - start AS first_word",
        f"least(stop, (rank + 1) * {block_words}) - greatest(start, rank * {block_words}) AS words",
    )
    return placed, pieces.join(schedule(spark, targets, block_words), ["sid", "rank"])


def taken_words(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The placed documents with ``taken``, the words that the mix takes from each, and ``first_slot``, where it comes first."""
    key = ["sid", "bucket", "nth"]
    sums = pieces.groupBy(*key).agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return placed.join(sums, key, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_blocks(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mix in the order of its schedule: (slot, source, epoch, doc_id, first_word, words), sorted.

    Pieces of one slot are a block of ``block_words`` words of one source; a document that does not fit
    goes on in the source's next block.
    """
    placed, pieces = mix(spark, docs, id_col, text_col, source_col, block_words)
    rows = pieces.join(placed.select("sid", "bucket", "nth", "source", "doc_id", "pos"), ["sid", "bucket", "nth"])
    order = ["slot", "epoch", "pos", "first_word", "bucket", "nth"]
    return rows.orderBy(*order).select("slot", "source", "epoch", "doc_id", "first_word", "words")


def mixed_documents(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The documents as the mix takes them: whole copies, and one cut copy where a source's quota ends.

    A cut copy keeps the first words of its text with the white space between them, and
    ``n_chars``, where that column exists, follows its text.
    """
    columns = docs.columns
    docs, row = numbered(spark, docs, "mixing_rows")
    taken = taken_words(*mix(spark, docs, id_col, text_col, source_col, row_col=row)).where("taken > 0")
    key, size, words, copy = (fresh(docs, c) for c in ("_key", "_size", "_taken", "_copy"))
    takes = taken.select(F.col("row").alias(key), F.col("size").alias(size), F.col("taken").alias(words))
    rows = docs.join(takes, F.col(row) == F.col(key))
    rows = rows.withColumn(copy, F.explode(F.expr(f"sequence(1L, ({words} + {size} - 1) div {size})")))
    cut = F.col(words) - (F.col(copy) - 1) * F.col(size)
    lead = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    whole = F.col(text_col)
    text = F.when(cut >= F.col(size), whole).otherwise(F.array_join(F.slice(lead, F.lit(1), cut.cast("int")), ""))
    rows = rows.withColumn(text_col, text)
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.when(cut >= F.col(size), F.col("n_chars")).otherwise(F.length(text_col)))
    return rows.select(*columns)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = taken_words(*mix(spark, table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


OP2_SQL = """
WITH sized AS (
    SELECT doc_id, source,
           CAST(length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix'), 1, 12) AS BIGINT) AS place
    FROM documents
), listed AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, CAST(CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
           3.0::DOUBLE * source_size AS cap FROM listed
), summed AS (
    SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS weights,
           coalesce(sum(cap) OVER filling, 0) AS capped_before, coalesce(sum(weight) OVER filling, 0) AS weight_before
    FROM weighed
    WINDOW filling AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
    SELECT *, cap * (weights - weight_before) <= (total - capped_before) * weight AS filled FROM summed
), levelled AS (
    SELECT *, (total - coalesce(sum(CASE WHEN filled THEN cap END) OVER (), 0))
              / sum(CASE WHEN NOT filled THEN weight END) OVER () AS level FROM marked
), targets AS (
    SELECT source, source_size, round(CASE WHEN filled THEN cap ELSE least(cap, level * weight) END, 6) AS target
    FROM levelled
), placed AS (
    SELECT s.doc_id, s.size, t.source, t.source_size, t.target, CAST(floor(t.target + 1e-6) AS BIGINT) AS quota,
           CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), wanted AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid, CAST(floor(target + 1e-6) AS BIGINT) AS quota FROM targets
), shares AS (
    SELECT *, (quota + 511) // 512 AS blocks, CAST(sum(quota) OVER (ORDER BY sid) AS BIGINT) AS upto,
           CAST(sum(quota) OVER () AS DOUBLE) AS everything FROM wanted
), edged AS (
    SELECT sid, source, blocks, CAST(floor((upto - quota) / everything * 1099511627776) AS BIGINT) AS low,
           CAST(floor(upto / everything * 1099511627776) AS BIGINT) AS high FROM shares WHERE everything > 0
), points AS (
    SELECT slot, CAST('0b' || reverse(lpad(bin(slot), 40, '0')) AS BIGINT) AS point
    FROM (SELECT unnest(range(CAST(sum(blocks) AS BIGINT))) AS slot FROM shares)
), ranked AS (
    SELECT slot, sid, blocks, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
    FROM points JOIN edged ON point >= low AND point < high
), used AS (
    SELECT slot, sid, rank FROM ranked WHERE rank < blocks
), late AS (
    SELECT sid, unnest(range(have, blocks)) AS rank
    FROM (SELECT s.sid, s.blocks, count(u.sid) AS have FROM shares s LEFT JOIN used u USING (sid) GROUP BY s.sid, s.blocks)
), slots AS (
    SELECT * FROM used UNION ALL
    SELECT (SELECT CAST(sum(blocks) AS BIGINT) FROM shares) + row_number() OVER (ORDER BY rank, sid) - 1, sid, rank FROM late
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
            (quota // source_size) * size
            + least(size, greatest(0, quota % source_size - pos)) END AS BIGINT) AS taken,
       CASE WHEN size > 0 AND pos < quota THEN slot END AS first_slot
FROM placed JOIN (SELECT source, sid FROM wanted) w ON placed.source IS NOT DISTINCT FROM w.source
LEFT JOIN slots ON slots.sid = w.sid AND slots.rank = pos // 512
"""
