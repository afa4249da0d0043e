"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree. DataFrame functions only.

The documents of a source form one stream of words in a pseudo-random order. The mix takes the first ``target`` words of
that stream, going round at most twice, in blocks of equal size. The blocks of all sources are dealt to the output shards
by a tree: every node splits its exact block quotas between its two halves by multivariate-hypergeometric draws. Shards
then own disjoint block ranges of each permuted stream and shuffle what they hold locally.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.session import stored

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    weights: tuple = (3, 1, 2)   # of the sources by code point, null last, repeating
    volume: float = 1.5          # words to take / words there are
    max_repeats: int = 2         # times a source is read at most
    block_words: int = 4096
    shard_words: int = 1 << 21   # of an output shard, at most
    bucket_rows: int = 4096      # documents that are ordered together
    seed: int = 17


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, place, docs, source_size, target, take): one row per source; ``take`` is the target in whole words.

    A source's target is its weight's share of the volume, at most ``max_repeats`` times its size; what is cut off is
    shared among the others by weight until none is above. That level is found in closed form: sources sorted by
    capacity / weight are capped as long as their capacity lies below the share left for them.
    """
    totals = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.pmod(F.col("place") - 1, F.lit(len(mix.weights))) + 1)
                          .cast("int")).cast("double")
    capacity = F.col("source_size").cast("double") * mix.max_repeats
    everything = Window.partitionBy(F.lit(0))
    rising = Window.orderBy("_full_at", "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (totals.withColumn("place", F.row_number().over(by_name)).withColumn("_weight", weight)
              .withColumn("_capacity", capacity).withColumn("_full_at", F.col("_capacity") / F.col("_weight"))
              .withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(mix.volume)))
              .withColumn("_open", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
              .withColumn("_used", F.coalesce(F.sum("_capacity").over(before), F.lit(0.0)))
              .withColumn("_level", (F.col("_all") - F.col("_used")) / F.col("_open"))
              # The level holds from the first source that stays below its capacity.
              .withColumn("_first", F.first(F.when(F.col("_full_at") > F.col("_level"), F.col("_level")), True)
                          .over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    target = F.when(F.col("_first").isNull(), F.col("_capacity")).otherwise(F.col("_first") * F.col("_weight"))
    take = F.least(F.round("target").cast("long"), F.col("source_size") * mix.max_repeats)
    return ranked.withColumn("target", target).select("source", "place", "docs", "source_size", "target",
                                                      take.alias("take"))


def _draw(i: str) -> str:
    """SQL: how many of the ``quotas[i]`` blocks go left, an inverse-CDF hypergeometric draw.

    The node's lambda state ``s`` holds the blocks of the sources not drawn yet (``pool``) and the room left on the left
    side (``room``). Weights follow from the ratio of neighbouring probabilities, starting eight standard deviations
    below the mean, which leaves out less than 1e-14.
    """
    q = f"cast(quotas[{i}] as double)"
    mean = f"(s.room * {q} / s.pool)"
    deviation = f"sqrt(greatest({mean} * (1 - {q} / s.pool) * (s.pool - s.room) / greatest(s.pool - 1, 1.0D), 0.0D))"
    low = f"cast(greatest(0.0D, s.room - (s.pool - {q}), floor({mean} - 8 * {deviation}) - 1) as bigint)"
    high = f"cast(least({q}, s.room, ceil({mean} + 8 * {deviation}) + 1) as bigint)"
    ratio = f"(({q} - k) * (s.room - k) / ((k + 1.0D) * (s.pool - {q} - s.room + k + 1.0D)))"
    zero = "named_struct('w', 1.0D, 'sum', 0.0D, 'at', cast(null as bigint))"
    step = f"w.w * {ratio}"
    total = (f"aggregate(sequence({low}, {high}), {zero}, (w, k) -> named_struct('w', {step}, 'sum', w.sum + w.w, "
             f"'at', w.at), w -> w.sum)")
    return (f"aggregate(sequence({low}, {high}), named_struct('w', 1.0D, 'sum', 0.0D, 'at', cast(null as bigint), "
            f"'goal', {total} * u[{i}]), (w, k) -> named_struct('w', {step}, 'sum', w.sum + w.w, "
            f"'at', coalesce(w.at, if(w.sum + w.w >= w.goal, k, null)), 'goal', w.goal), "
            f"w -> coalesce(w.at, {high}))")


def shard_quotas(targets: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(place, shard, blocks): exact block quotas of each source in each shard.

    The tree is as deep as shards of ``shard_words`` ask for. A node is one row with one quota per source: its size is that
    of the list of weighted sources.
    """
    total = targets.agg(F.coalesce(F.sum("take"), F.lit(0))).first()[0]
    levels = max(0, -(-total // mix.shard_words) - 1).bit_length()
    blocks = F.ceil(F.col("take") / F.lit(mix.block_words)).cast("long")
    quotas = F.transform(F.array_sort(F.collect_list(F.struct("place", blocks.alias("n")))), lambda x: x["n"])
    nodes = targets.agg(quotas.alias("quotas")).select(F.lit(0).cast("long").alias("node"), "quotas")
    for level in range(levels):
        uniform = (f"transform(quotas, (q, i) -> (pmod(xxhash64({mix.seed}, {level}, node, i), 9007199254740992) + 0.5D)"
                   f" / 9007199254740992.0D)")
        start = ("named_struct('pool', cast(aggregate(quotas, 0L, (a, q) -> a + q) as double), "
                 "'room', cast(aggregate(quotas, 0L, (a, q) -> a + q) div 2 as double), 'left', cast(array() as array<bigint>))")
        taken = f"if(s.pool <= 0, 0L, {_draw('i')})"
        # One source after the other: the number drawn leaves the room, the source's blocks leave the pool.
        fold = (f"aggregate(sequence(0, size(quotas) - 1), {start}, (s, i) -> transform(array({taken}), l -> named_struct("
                f"'pool', s.pool - quotas[i], 'room', s.room - l, 'left', concat(s.left, array(l))))[0], s -> s.left)")
        halves = (nodes.filter(F.size("quotas") > 0).withColumn("u", F.expr(uniform)).withColumn("left", F.expr(fold))
                  .withColumn("right", F.expr("transform(quotas, (q, i) -> q - left[i])")))
        side = F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
                                 F.struct((F.col("node") * 2 + 1).alias("node"), F.col("right").alias("quotas"))))
        nodes = halves.select(side.alias("side")).select("side.*")
    return nodes.select(F.col("node").alias("shard"), F.posexplode("quotas").alias("i", "blocks")).select(
        (F.col("i") + 1).cast("int").alias("place"), "shard", "blocks")


def block_owners(quotas: DataFrame) -> DataFrame:
    """(place, block, shard): the shards take consecutive runs of each source's permuted blocks."""
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = quotas.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0))).filter("blocks > 0")
    numbers = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1))
    return runs.select("place", "shard", numbers.alias("block"))


def draws(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          mix: Mix = Mix(), carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target and ``taken``: array of (shard, order, words).

    ``words`` counts from the start of the document; at most the last document a source gives is taken in part. A null
    text has no words and is never taken; null sources form one source; rows that repeat an id are separate documents.
    Equal input gives equal output, however it is partitioned. With ``carry`` the input row comes along as struct
    ``row``. An empty table gives no rows.
    """
    # Of equal rows it does not matter which comes first: they only change places.
    tie = F.xxhash64(F.lit(mix.seed), F.col(id_col).cast("string"), F.col(text_col))
    columns = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"),
               tie.alias("key")]
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    sized = docs.select(*columns)
    narrow = stored(sized.select("doc_id", "source", "size", "key"), "sizes")
    targets = stored(source_targets(narrow, mix), "targets").withColumnRenamed("source", "name")
    owners = block_owners(shard_quotas(targets, mix))
    buckets = F.ceil(F.col("docs") / F.lit(mix.bucket_rows)).cast("long")
    bucket = F.pmod(F.shiftrightunsigned("key", 20), buckets)
    known = targets.select("name", "place", "docs", "source_size", "target", "take")
    rows = (narrow if not carry else sized).join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name", "source") \
        .withColumn("bucket", bucket)
    sums = (narrow.join(known, F.col("source").eqNullSafe(F.col("name"))).withColumn("bucket", bucket)
            .groupBy("place", "bucket").agg(F.sum("size").alias("_sum")))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("place", "bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("place", "bucket").orderBy("key", "doc_id", "size")
    begin = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (rows.withColumn("begin", begin).join(offsets, ["place", "bucket"])
              .withColumn("begin", F.col("begin") + F.col("offset")))
    # Copy r of a document starts r rounds of the stream later; it belongs to the block in which it starts.
    copies = F.transform(F.sequence(F.lit(0), F.lit(mix.max_repeats - 1)), lambda r: F.struct(
        r.alias("round"), F.floor((r * F.col("source_size") + F.col("begin")) / F.lit(mix.block_words)).alias("block"),
        F.greatest(F.least(F.col("size"), F.col("take") - r * F.col("source_size") - F.col("begin")), F.lit(0))
        .alias("words")))
    keyed = placed.withColumn("copies", F.filter(copies, lambda c: c["words"] > 0))
    out = ["doc_id", "size", "source_size", "target", *(["row"] if carry else [])]
    for r in range(mix.max_repeats):
        owner = owners.select("place", "block", F.col("shard").alias(f"shard_{r}"))
        own = F.expr(f"get(filter(copies, c -> c.round = {r}), 0).block")
        keyed = keyed.withColumn("block", own).join(owner, ["place", "block"], "left").drop("block")
    taken = F.transform("copies", lambda c: F.struct(
        F.element_at(F.array(*[F.col(f"shard_{r}") for r in range(mix.max_repeats)]), (c["round"] + 1).cast("int"))
        .alias("shard"), F.xxhash64(F.lit(mix.seed), F.col("key"), c["round"]).alias("order"), c["words"].alias("words")))
    return keyed.withColumn("taken", taken).select(*out, "taken")


def first_words(text: Column, words: Column) -> Column:
    """The first ``words`` words of a text, joined by single blanks."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.lit(1), words.cast("int")), " ")


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), **columns) -> DataFrame:
    """The mix itself: rows of ``docs``, a document once per time it is taken, dealt to shards and shuffled in each.

    Columns are those of ``docs``. A document that is taken in part keeps that many words of its text.
    """
    text_col = columns.get("text_col", "text")
    drawn = draws(docs, mix=mix, carry=True, **columns).select("row", "size", F.explode("taken").alias("d"))
    rows = drawn.select(F.col("d.shard").alias("_s"), F.col("d.order").alias("_o"), F.col("d.words").alias("_w"),
                        F.col("size").alias("_n"), F.struct("row").alias("_r"))
    dealt = rows.repartition(F.col("_s")).sortWithinPartitions("_s", "_o")
    out = []
    for c in docs.columns:
        value = F.col("_r.row").getField(c)
        if c == text_col:
            value = F.when(F.col("_w") < F.col("_n"), first_words(value, F.col("_w"))).otherwise(value)
        out.append(value.alias(c))
    return dealt.select(*out)
