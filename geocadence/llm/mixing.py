"""Mixing sources to target weights, in DataFrame expressions only.

The words of each source, its documents in a fixed hash order, are one stream that is cut into blocks of ``block`` words.
Targets follow the weights; a target stops at ``most`` times the words of its source and the excess goes to the others by
weight. A source's slots are its target in blocks. All slots are dealt to output shards of ``shard_slots`` slots by a
keyed permutation of the slot numbers: each shard's source counts are a multinomial draw conditioned on the totals, so
the totals meet their targets to the word. Slot i of a source reads block ``permutation(i mod blocks)`` of that source
under a second keyed permutation, a new one for every pass over the source, so a block repeats only after all others were read;
the last slot reads only the words that the target still lacks. Permutations are closed formulas (swap-or-not rounds
over [0, n)), so slots, blocks and documents meet in equi-joins by index and nothing is sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geocadence.llm.tables import numbered, shards_of
from geocadence.session import stored

BLOCK, SHARD_SLOTS, MOST, ROUNDS, SEED = 512, 1024, 3, 24, 20
WEIGHTS = (5, 2, 1)
_WORD = r"[^\x20\x09-\x0D]+"


def permuted(x: Column, n: Column, *key: Column, inverse: bool = False) -> Column:
    """Place of x (0 to n - 1) under a pseudorandom permutation of [0, n) that ``key`` chooses, or the x of a place.

    Swap-or-not: every round pairs x with (k - x) mod n and swaps the pair by a bit that both share, so each round undoes
    itself for any n, and the rounds backwards are the inverse.
    """
    def step(at, number):
        other = F.pmod(F.pmod(F.xxhash64(number, *key), n) - at, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(at, other), number, *key, F.lit(1)), F.lit(2)) == 0, at).otherwise(other)
    rounds = range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(i) for i in (reversed(rounds) if inverse else rounds)]), x.cast("long"), step)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), a row per source, null last by code point.

    With sources sorted by most * size / weight, the capped ones come first; the level at a place is the words left over
    the weight left when all before it are capped. The windows run over sources only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")))
    cap = most * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.withColumn("_cap", cap).withColumn("_total", F.sum("source_size").over(whole)).withColumn("_weights", F.sum("weight").over(whole))
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # the levels rise up to the first source that is not capped and fall behind it: the highest holds for all
    final = F.max("_level").over(whole)
    target = F.least(F.col("_cap").cast("double"), final * F.col("weight"))
    rows = rows.withColumn("_level", level)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with row_id, 128 bits of hash that equal rows share."""
    own = [F.col("doc_id"), F.col("text"), F.col("source")]
    return docs.withColumn("row_id", F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), *own)), 16, "0") for k in (1, 2)]))


def mixed_pieces(docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix of ``docs`` (doc_id LONG, text STRING, source STRING; other columns are not read).

    documents: (row_id, copy, doc_id, size, source_size, target), a row per row of ``docs``; copy tells equal rows apart.
    pieces: (row_id, copy, size, start, length, times, part, first_shard): words [start, start + length) of a document are taken
    ``times`` times in whole and the first ``part`` of them once more. What is never taken is absent. Null and wordless texts
    have size 0 and no pieces; a null doc_id or source is a value like any other.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    rows = with_row_ids(docs).select("row_id", F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.select("row_id", "doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    rows = stored(rows.withColumn("source_id", F.xxhash64("source", F.col("source").isNull())), "mix-documents")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = stored(sources.withColumn("source_id", F.xxhash64("source", F.col("source").isNull())), "mix-sources")

    # the stream of a source: where each document starts, and its pieces in blocks
    placed = numbered(rows.where("size > 0"), ["source_id"], ["row_id", "copy"], "size", "begin")
    first, last = F.col("begin").cast("long") / block, (F.col("begin") + F.col("size") - 1) / block
    pieces = placed.select("row_id", "copy", "source_id", "begin", "size", F.explode(F.sequence(F.floor(first), F.floor(last))).alias("block"))
    start = F.greatest(F.col("begin"), F.col("block") * block)
    length = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block) - start
    pieces = pieces.select("row_id", "copy", "size", "source_id", "block", (start - F.col("begin")).alias("start"), length.alias("length"), (start - F.col("block") * block).alias("at"))

    whole = F.col("words") == F.col("length")
    taken = mixed_slots(sources, block, seed).groupBy("source_id", "block").agg(
        F.count_if(whole).alias("times"), F.sum(F.when(whole, 0).otherwise(F.col("words"))).alias("extra"), F.min("shard").alias("first_shard"))
    part = F.greatest(F.lit(0), F.least(F.col("length"), F.col("extra") - F.col("at")))
    pieces = pieces.join(taken, ["source_id", "block"]).select("row_id", "copy", "size", "start", "length", "times", part.alias("part"), "first_shard")
    documents = rows.join(sources.select("source_id", "source_size", "target"), "source_id")
    return documents.select("row_id", "copy", "doc_id", "size", "source_size", "target"), pieces.where("times > 0 OR part > 0")


def mixed_slots(sources: DataFrame, block: int = BLOCK, seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, place, source_id, pass, block, length, words): which block each slot of each output shard reads, and how many of its words.

    Everything a slot needs is computed per source and pass before the slots are laid out, a thousand to a row first,
    so a large source is laid out by many tasks and no slot meets another.
    """
    c = F.col
    plan = sources.where("source_size > 0").select("source_id", "source_size", F.floor(c("target") + 1e-6).cast("long").alias("due"))
    plan = plan.withColumn("blocks", F.ceil(c("source_size") / block).cast("long")).withColumn("passes", F.expr("due div source_size"))
    plan = plan.withColumn("tail", c("source_size") - (c("blocks") - 1) * block)
    plan = plan.select("*", F.explode(F.sequence(F.lit(0).cast("long"), c("passes"))).alias("pass"))
    key = [c("source_id"), c("pass"), F.lit(seed)]
    plan = plan.withColumn("last_at", permuted(c("blocks") - 1, c("blocks"), *key, inverse=True))
    left = F.when(c("pass") < c("passes"), c("source_size")).otherwise(c("due") - c("passes") * c("source_size"))
    plan = plan.withColumn("left", left).where(c("left") > 0)
    even = F.ceil(c("left") / block)  # slots if the short last block is not among them
    plan = plan.withColumn("slots", F.when(c("last_at") >= even, even).otherwise(F.ceil((c("left") + block - c("tail")) / block)).cast("long"))
    earlier = F.sum("slots").over(Window.orderBy("source_id", "pass").rowsBetween(Window.unboundedPreceding, -1))
    plan = plan.withColumn("from", F.coalesce(earlier, F.lit(0))).withColumn("all", F.sum("slots").over(Window.partitionBy()))

    parts = plan.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(slots - 1) div 1000"))).alias("part"))
    slots = parts.repartition(shards_of(sources.sparkSession), c("source_id"), c("pass"), c("part"))  # a stated number is not folded into fewer tasks
    slots = slots.select("*", F.explode(F.sequence(c("part") * 1000, F.least(c("slots"), (c("part") + 1) * 1000) - 1)).alias("i"))
    slots = slots.withColumn("block", permuted(c("i"), c("blocks"), *key))
    slots = slots.withColumn("length", F.when(c("block") == c("blocks") - 1, c("tail")).otherwise(F.lit(block)))
    before = c("i") * block - F.when(c("i") > c("last_at"), block - c("tail")).otherwise(0)
    slots = slots.withColumn("words", F.least(c("length"), c("left") - before))
    slots = slots.withColumn("number", permuted(c("from") + c("i"), c("all"), F.lit(seed), F.lit("deal")))
    return slots.select(F.floor(c("number") / shard_slots).alias("shard"), (c("number") % shard_slots).alias("place"), "source_id", "pass", "block", "length", "words")


def mix_counts(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_shard) per row of ``docs``: the words the mix takes of it, and the first shard that reads it."""
    documents, pieces = mixed_pieces(docs, **settings)
    taken = pieces.groupBy("row_id", "copy").agg(F.sum(F.col("length") * F.col("times") + F.col("part")).alias("taken"), F.min("first_shard").alias("first_shard"))
    rows = documents.join(taken, ["row_id", "copy"], "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mixed_documents(docs: DataFrame, most: int = MOST, **settings) -> DataFrame:
    """The mix as rows of ``docs``: a document is there once for every time it is taken, with the words taken that time.

    A time that takes all words keeps the text as it is; otherwise the words taken stand in their order, a space between
    them, and n_chars, where there is one, is their length. Equal rows are documents of their own; each copy is there as often as it is taken.
    """
    _, pieces = mixed_pieces(docs, most=most, **settings)
    piece = F.struct("start", "length", "times", "part")
    takes = pieces.groupBy("row_id", F.col("copy").alias("_copy")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("size").alias("_size"))  # bounded by one text
    # copies of a row_id may differ in other columns: each variant has a range of the copies, dealt by the thousand
    plain = [F.to_json(c) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in docs.dtypes]
    rows = with_row_ids(docs).withColumn("_variant", F.xxhash64(*plain, *[F.col(c).isNull() for c in docs.columns]))
    copies = numbered(rows.groupBy("row_id", "_variant").agg(F.count(F.lit(1)).alias("_n")), ["row_id"], ["_variant"], "_n", "_from")
    copies = copies.select("row_id", "_variant", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i"), "_from")
    copies = copies.select("row_id", "_variant", F.expr("(_i - 1) div 1000").alias("_salt"), (F.col("_from") + F.col("_i")).alias("_copy")).join(takes, ["row_id", "_copy"])
    rows = rows.groupBy("row_id", "_variant").agg(F.first(F.struct(*docs.columns)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    rows = rows.select("row_id", "_variant", "_row", F.explode(F.expr("sequence(0L, (_n - 1) div 1000)")).alias("_salt"))
    rows = rows.join(copies, ["row_id", "_variant", "_salt"]).select("_row.*", "pieces", "_size").withColumn("time", F.explode(F.sequence(F.lit(1), F.lit(most))))
    reads = F.transform("pieces", lambda p: F.struct(p["start"].alias("start"), F.when(p["times"] >= F.col("time"), p["length"]).when(p["times"] + 1 == F.col("time"), p["part"]).otherwise(0).alias("n")))
    rows = rows.withColumn("reads", F.filter(reads, lambda p: p["n"] > 0)).where(F.size("reads") > 0)
    n = F.aggregate("reads", F.lit(0).cast("long"), lambda s, p: s + p["n"])
    some = F.array_join(F.flatten(F.transform("reads", lambda p: F.slice("_words", (p["start"] + 1).cast("int"), p["n"].cast("int")))), " ")
    rows = rows.withColumn("_words", F.when(n < F.col("_size"), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))))  # of cut texts only
    rows = rows.withColumn("_text", F.when(F.col("_words").isNull(), F.col("text")).otherwise(some))
    swap = {"text": F.col("_text")} | ({"n_chars": F.length("_text").cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {})
    return rows.select(*[swap.get(x, F.col(x)).alias(x) for x in docs.columns])
