"""Conversations from messages that quote each other.

1. The lines of a message are parsed into quote levels (``>`` marks, nested by repetition, spaces between them allowed). Lines of level
   0 are the message's own; a line that announces a quotation ("... wrote:") right before one is dropped with it.
2. Quoted passages (runs of lines of one level) and their single lines are normalised (white space, case) and hashed, and so are the
   own text and the own lines of every message.
3. A message replies to an owner of what it quotes at its lowest quote level; the owner must come before the message. Of several owners
   of a hash those count that quote one level below what stands one level below the quotation (nothing, if nothing stands there), else
   all; of these the first or the latest earlier one. Of several hashes, those settled by such a deeper quotation come first,
   then the longest, then the first in the text. A hash with one owner is an equi-join; for the others owners and quoters are one
   table, dealt by hash and id range, with a running owner carried from range to range: no pairs are made, however often a passage occurs.
4. Roots and depths follow from the reply links by doubling: every round joins each message with its farthest known
   ancestor, so the rounds are the logarithm of the longest chain; messages that have reached their root rest.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches, batch, shards_of
from geocadence.llm.words import portions
from geocadence.session import stored

_MARK = re.compile(r"[ \t]{0,3}>")
_WROTE = re.compile(r"(?i)\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$")
_PARSED = pa.schema([("message_id", pa.int64()), ("own", pa.string()), ("units", pa.list_(pa.struct([("level", pa.int32()), ("at", pa.int32()), ("text", pa.string())]))),
                     ("quoted", pa.list_(pa.struct([("level", pa.int32()), ("text", pa.string())])))])


def level_of(line: str) -> tuple[int, str]:
    """Quote level of a line, and the line without its marks."""
    level, at = 0, 0
    while (mark := _MARK.match(line, at)) is not None:
        level, at = level + 1, mark.end()
    return level, line[at:].removeprefix(" ") if level else line


def normal(text: str) -> str:
    return " ".join(text.split()).lower()


def parsed(text: str | None) -> tuple[str, list[tuple[int, int, str]]]:
    """(own text without quotes, units): a unit is (level, place, normalised text), level 0 for what the message itself says."""
    return parsed_levels(text)[:2]


def parsed_levels(text: str | None) -> tuple[str, list[tuple[int, int, str]], list[tuple[int, str]]]:
    """As ``parsed``, and (level, all that is quoted there, normalised) of every quote level."""
    lines = [level_of(line) for line in (text or "").splitlines()]
    own, units, run, run_level = [], [], [], 0

    def close():
        whole = normal(" ".join(run))
        if whole:
            units.append((run_level, len(units), whole))
            if len(run) > 1:
                units.extend((run_level, len(units) + i, normal(x)) for i, x in enumerate(run) if normal(x))
        run.clear()

    for i, (level, line) in enumerate(lines):
        if level == 0:
            announces = i + 1 < len(lines) and _WROTE.search(line) and any(x[0] for x in lines[i + 1:i + 3])
            if not announces:
                own.append(line)
        if level != run_level:
            if run_level:
                close()
            run_level = level
        if level:
            run.append(line)
    if run_level:
        close()
    body = "\n".join(own).strip("\n")
    for x in dict.fromkeys([normal(body), *map(normal, body.splitlines())]):
        if x:
            units.append((0, len(units), x))
    quoted: dict[int, list[str]] = {}
    for level, line in lines:
        if level and line.strip():
            quoted.setdefault(level, []).append(line)
    return body, units, [(level, normal(" ".join(x))) for level, x in quoted.items()]


def owners_before(asked: DataFrame, owned: DataFrame, keys: list[str], cuts: list[int], latest: bool) -> DataFrame:
    """``asked`` with ``owner``: of the rows of ``owned`` with the same keys and a smaller message_id, the latest one's or else the first one's; null without any.

    Rows are dealt by key and id range (between ``cuts``), so a key with all rows is many tasks; per key only ranges meet.
    """
    pick, best = (F.max, F.greatest) if latest else (F.min, F.least)
    both = asked.withColumn("_own", F.lit(None).cast("long")).unionByName(owned.select(*keys, "message_id", F.col("message_id").alias("_own")), allowMissingColumns=True)
    if cuts:
        both = Bucketizer(splits=[-math.inf, *sorted({float(x) for x in cuts}), math.inf], inputCol="message_id", outputCol="_range").transform(both)
    else:
        both = both.withColumn("_range", F.lit(0.0))
    ranges = both.groupBy(*keys, "_range").agg(pick("_own").alias("_mine"))
    carried = pick("_mine").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*keys, "_range", carried.alias("_carried"))
    # at one id quoters come before owners: nobody replies to itself
    order = Window.partitionBy(*keys, "_range").orderBy("message_id", F.col("_own").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = both.withColumn("_inner", pick("_own").over(order)).where("_own IS NULL").join(ranges, [*keys, "_range"])
    return rows.select(*[F.col(c) for c in asked.columns], best("_inner", "_carried").alias("owner"))


def owners_of_quotations(units: DataFrame, latest: bool) -> DataFrame:
    """(message_id, level, size, at, owner, deep) of each quoted unit that an earlier message owns; deep: a deeper quotation agrees."""
    said, quoted = units.where("level = 0"), units.where("level > 0")
    owners = said.groupBy("h1", "h2").agg(F.min("message_id").alias("first"), F.max("message_id").alias("last"), F.min("below").alias("first_below"), F.max("below").alias("last_below"))
    owners = stored(owners.withColumn("single", F.expr("first = last AND first_below = last_below")).drop("last", "last_below"), "quotes-owners")
    found = quoted.join(owners.where("single"), ["h1", "h2"]).where("first < message_id").select(
        "message_id", "level", "size", "at", F.col("first").alias("owner"), F.expr("below = first_below AND below <> 0").alias("deep"))

    shared = owners.where("NOT single").select("h1", "h2", "first")
    owned = stored(said.join(shared, ["h1", "h2"]).select("h1", "h2", "below", "message_id"), "quotes-shared")
    asked = stored(quoted.join(shared, ["h1", "h2"]).where("first < message_id").select("message_id", "level", "size", "at", "h1", "h2", "below"), "quotes-asked")
    parts = min(512, 4 * shards_of(units.sparkSession))
    cuts = owned.unionByName(asked.select("h1", "h2", "below", "message_id")).agg(F.percentile_approx("message_id", [i / parts for i in range(1, parts)])).first()[0] or []
    near = stored(owners_before(asked, owned, ["h1", "h2", "below"], cuts, latest), "quotes-near")
    rest = owners_before(near.where("owner IS NULL").drop("owner"), owned, ["h1", "h2"], cuts, latest)
    columns = ["message_id", "level", "size", "at", "owner"]
    near = near.where("owner IS NOT NULL").select(*columns, (F.col("below") != 0).alias("deep"))
    return found.unionByName(near).unionByName(rest.select(*columns, F.lit(False).alias("deep")))


def conversations(messages: DataFrame, rounds: int = 40, latest: bool = False) -> DataFrame:
    """(conversation, depth, message_id, reply_to, text), sorted by conversation, depth and message_id.

    ``messages``: (message_id LONG, text STRING); smaller ids come earlier. conversation is the root's message_id, reply_to the
    message whose words are quoted (null for a root), text the message without quotes; a null text is empty. Rows with a null
    message_id are left out; rows that repeat a message_id each appear, and quote for one another's replies: the smallest owner
    found by any of them is the one replied to. Other columns are not read. Where several earlier messages say what is quoted and
    quote the same themselves, the text cannot tell them apart: the first of them is replied to, or with ``latest`` the latest.
    """
    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            rows = [parsed_levels(t) for t in b.column("text").to_pylist()]
            units = [[{"level": level, "at": at, "text": x} for level, at, x in u] for _, u, _ in rows]
            quoted = [[{"level": level, "text": x} for level, x in q] for _, _, q in rows]
            yield batch(_PARSED, message_id=b.column("message_id"), own=[body for body, _, _ in rows], units=units, quoted=quoted)

    rows = messages.select(F.col("message_id").cast("long").alias("message_id"), "text").where("message_id IS NOT NULL")
    rows = rows.mapInArrow(run, "message_id long, own string, units array<struct<level: int, at: int, text: string>>, quoted array<struct<level: int, text: string>>")
    below = F.map_from_entries(F.transform("quoted", lambda q: F.struct(q["level"], F.xxhash64(q["text"]))))
    rows = rows.select("message_id", "own", "units", below.alias("quoted"))
    hashed = F.transform("units", lambda u: F.struct(
        u["level"].alias("level"), u["at"].alias("at"), F.length(u["text"]).alias("size"), F.xxhash64(u["text"]).alias("h1"), F.xxhash64(u["text"], F.lit(2)).alias("h2"),
        F.coalesce(F.try_element_at("quoted", u["level"] + 1), F.lit(0).cast("long")).alias("below")))
    rows = stored(rows.select("message_id", "own", hashed.alias("units")), "quotes-parsed")
    found = owners_of_quotations(rows.select("message_id", F.inline("units")), latest)
    # lowest level, then settled by a deeper quotation, then longest, then first in the text
    links = stored(found.groupBy("message_id").agg(F.min_by("owner", F.struct("level", ~F.col("deep"), -F.col("size"), "at", "owner")).alias("reply_to")).where("reply_to IS NOT NULL"), "quotes-links")
    ids = rows.select("message_id").distinct()
    chain = ids.join(links, "message_id", "left").select(
        "message_id", F.coalesce("reply_to", "message_id").alias("far"), F.col("reply_to").isNotNull().cast("long").alias("depth"), F.col("reply_to").isNotNull().alias("open"))
    chain = stored(chain, "quotes-chain")
    for _ in range(rounds):
        step = chain.where("depth > 0").select(F.col("message_id").alias("far"), F.col("far").alias("next"), F.col("depth").alias("more"))
        moved = chain.where("open").join(step, "far", "left").select(
            "message_id", F.coalesce("next", "far").alias("far"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("open"))
        chain = stored(moved.unionByName(chain.where("NOT open")), "quotes-chain")  # what has reached its root rests
        if chain.where("open").isEmpty():
            break
    else:
        raise RuntimeError(f"reply chains are longer than 2 ** {rounds}")
    out = rows.select("message_id", F.col("own").alias("text")).join(chain.select("message_id", "far", "depth"), "message_id").join(links, "message_id", "left")
    return out.select(F.col("far").alias("conversation"), "depth", "message_id", "reply_to", "text").orderBy("conversation", "depth", "message_id")
