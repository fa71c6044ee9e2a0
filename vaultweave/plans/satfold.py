"""The satellite rule over many loads in one pass.

Rule per pk, loads in order: of the load's hash diffs those that are not in the latest set are inserted, and when
there are any, they become the latest set. Hash diffs of a pk that occur in the same loads (and start inside or
outside the latest set alike) are treated alike all the way, so the fold runs over *patterns*: a bit mask of the loads a
hash diff occurs in. Per pk, an ``aggregate`` over the loads keeps for each pattern whether it is in the latest set and
at which loads it was inserted; the answer of a pattern then goes back to its hash diffs.

Steps, the same for 2 loads or 60: masks per (pk, hash diff), distinct patterns per pk, the fold per pk, one join on
(pk, pattern). Everything before the fold combines map-side, and a pk with any number of hash diffs reaches it as its distinct
patterns. Where a pk has more than ``PATTERNS`` of them (only possible from 13 loads on), its loads are
folded in stretches of ``STRETCH``, with the latest set carried from one to the next: a stretch has at most
2 ** (``STRETCH`` + 1) patterns, so what one row holds is bounded for every input. The join back is salted,
as a hot pk may have most of its hash diffs in one pattern.

A NULL hash diff never matches: it is inserted at every load it occurs in and makes that load its pk's latest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.session import materialize

#: loads that a mask holds
MASK_BITS = 62
#: patterns of one pk that are folded in one row
PATTERNS = 1 << 13
STRETCH = 11
SALTS = 8
#: of the files between two steps
CODEC = "zstd"
KEY = ["sat", "pk"]
PATTERN = ["mask", "held", "never"]
CARRIED = [*PATTERN, "salts"]


def occurrences(keys: DataFrame, latest: DataFrame | None) -> DataFrame:
    """``sat, pk, hd, mask, held, never`` of ``keys`` (``sat, pk, hd, load``, load from 0; hd '' is a NULL one) and the
    latest set before the first load (``sat, pk, hd``), of pks that have loads."""
    rows = keys.select(*KEY, "hd", F.expr("shiftleft(1L, cast(load as int))").alias("mask"), F.lit(False).alias("held"))
    if latest is not None:
        held = latest.join(keys.select(*KEY).distinct(), KEY, "left_semi")
        rows = rows.unionByName(held.select(*KEY, "hd", F.lit(0).cast("long").alias("mask"), F.lit(True).alias("held")))
    return (rows.groupBy(*KEY, "hd").agg(F.bit_or("mask").alias("mask"), F.max("held").alias("held"))
            .withColumn("never", F.col("hd") == ""))


def _folded(patterns: DataFrame, loads: int) -> DataFrame:
    """Per pk and pattern: ``ins``, the mask of loads that insert it, and ``ends``, whether it is in the latest set at the end."""
    carry = lambda c: [c[x].alias(x) for x in CARRIED]
    start = F.transform("patterns", lambda c: F.struct(*carry(c), c["held"].alias("now"), F.lit(0).cast("long").alias("ins")))

    def load(state, bit):
        enters = lambda c: (c["mask"].bitwiseAND(bit) != 0) & (c["never"] | ~c["now"])
        step = F.transform(state, lambda c: F.struct(*carry(c), enters(c).alias("now"), F.when(enters(c), c["ins"].bitwiseOR(bit)).otherwise(c["ins"]).alias("ins")))
        return F.when(F.exists(state, enters), step).otherwise(state)

    any_load = F.aggregate("patterns", F.lit(0).cast("long"), lambda a, c: a.bitwiseOR(c["mask"]))
    bits = F.filter(F.array(*[F.lit(1 << i).cast("long") for i in range(loads)]), lambda b: any_load.bitwiseAND(b) != 0)
    per_pk = patterns.groupBy(*KEY).agg(F.collect_list(F.struct(*PATTERN, "salts")).alias("patterns"))
    # a lone pattern needs no fold: it enters at its first load, and at every one when it never matches
    first = lambda c: F.when(c["held"], F.lit(0).cast("long")).otherwise(c["mask"].bitwiseAND(-c["mask"]))
    alone = F.transform("patterns", lambda c: F.struct(*[c[x].alias(x) for x in CARRIED], F.lit(True).alias("now"),
                                                       F.when(c["never"], c["mask"]).otherwise(first(c)).alias("ins")))
    ends = F.when(F.size("patterns") == 1, alone).otherwise(F.aggregate(bits, start, load))
    return (per_pk.select(*KEY, F.explode(ends).alias("c"))
            .select(*KEY, *[F.col(f"c.{p}").alias(p) for p in CARRIED], F.col("c.ins").alias("ins"), F.col("c.now").alias("ends")))


def _salt():
    return F.pmod(F.xxhash64("hd"), F.lit(SALTS)).cast("int")


def _patterns(occurs: DataFrame) -> DataFrame:
    """The distinct patterns of each pk, with ``salts``, a mask of the salts that its hash diffs have."""
    salt = F.call_function("shiftleft", F.lit(1).cast("long"), _salt()).alias("salts")
    return occurs.select(*KEY, *PATTERN, salt).groupBy(*KEY, *PATTERN).agg(F.bit_or("salts").alias("salts"))


def _answers(occurs: DataFrame, folded: DataFrame) -> DataFrame:
    """``sat, pk, hd, mask, ins, ends``: each hash diff with the answer of its pattern."""
    has = F.array_compact(F.array(*[F.when(F.col("salts").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(i)) for i in range(SALTS)]))
    spread = folded.select(*KEY, *PATTERN, "ins", "ends", F.explode(has).alias("salt"))
    return occurs.select(*KEY, "hd", *PATTERN, _salt().alias("salt")).join(spread, [*KEY, *PATTERN, "salt"]).select(*KEY, "hd", "mask", "ins", "ends")


def _one_stretch(occurs: DataFrame, loads: int) -> DataFrame:
    return _answers(occurs, _folded(_patterns(occurs), loads))


def inserted(answers: DataFrame, loads: int, first: int = 0) -> DataFrame:
    """``sat, pk, hd, load``, a row per insert."""
    took = lambda i: F.col("ins").bitwiseAND(F.lit(1 << i).cast("long")) != 0
    each = F.array(*[F.when(took(i), F.lit(first + i)) for i in range(loads)])
    return answers.where("ins != 0").select(*KEY, "hd", F.explode(F.array_compact(each)).alias("load"))


def skipped(answers: DataFrame, loads: int) -> dict[str, DataFrame]:
    """Per satellite that inserts more than it skips, the keys of loads that insert nothing for them: ``sat, pk, hd, load``."""
    left = F.col("mask").bitwiseAND(F.bitwise_not("ins"))
    few = answers.groupBy("sat").agg(F.sum(F.bit_count("ins")).alias("ins"), F.sum(F.bit_count(left)).alias("left")).where(F.col("left") < F.col("ins"))
    keys = inserted(answers.withColumn("ins", left), loads)
    return {r["sat"]: keys.where(F.col("sat") == r["sat"]) for r in few.collect()}


def fold(keys: DataFrame, loads: int, latest: DataFrame | None, work: str) -> DataFrame:
    """Inserted keys ``sat, pk, hd, load`` of all loads (0 to ``loads`` - 1), written under ``work``. ``keys``: distinct or
    not, ``sat, pk, hd, load``."""
    return fold_both(keys, loads, latest, work)[0]


def fold_both(keys: DataFrame, loads: int, latest: DataFrame | None, work: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Inserted keys as ``fold``, and ``skipped`` where all loads were folded at once."""
    out, answers = [], []
    for first in range(0, loads, MASK_BITS):                    # more loads than a mask holds: one after the other
        n = min(MASK_BITS, loads - first)
        part = keys if loads <= MASK_BITS else keys.where(F.col("load").between(first, first + n - 1))
        part = part.withColumn("load", F.col("load") - first)
        occurs = materialize(occurrences(part, latest), f"{work}/{first}/occurs", codec=CODEC)
        many = None
        if n > STRETCH + 1:
            distinct = occurs.select(*KEY, *PATTERN).distinct()
            many = materialize(distinct.groupBy(*KEY).count().where(F.col("count") > PATTERNS).select(*KEY), f"{work}/{first}/many", codec=CODEC)
            if many.isEmpty():
                many = None
        light = occurs if many is None else occurs.join(many, KEY, "left_anti")
        answers = [materialize(_one_stretch(light, n), f"{work}/{first}/answers", partition_by="sat", codec=CODEC)]
        out.append(inserted(answers[0], n, first))
        if many is not None:
            rows, ends = _in_stretches(occurs.join(many, KEY, "left_semi"), n, first, f"{work}/{first}")
            out.append(rows)
            answers.append(ends)
        if first + n < loads:
            now = [a.where("ends").select(*KEY, "hd") for a in answers]
            seen = [a.select(*KEY) for a in answers]
            for more in now[1:]:
                now[0] = now[0].unionByName(more)
            for more in seen[1:]:
                seen[0] = seen[0].unionByName(more)
            if latest is not None:                              # pks without a load keep their set
                now[0] = now[0].unionByName(latest.select(*KEY, "hd").join(seen[0].distinct(), KEY, "left_anti"))
            latest = materialize(now[0], f"{work}/{first}/latest", codec=CODEC)
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows, skipped(answers[0], loads) if len(out) == 1 else {}


def _in_stretches(occurs: DataFrame, loads: int, first: int, work: str) -> tuple[DataFrame, DataFrame]:
    """Pks of many patterns, ``STRETCH`` loads at a time: inserted keys, and hash diffs with ``ends``."""
    rows, held = None, occurs.select(*KEY, "hd", "held")
    for a in range(0, loads, STRETCH):
        n = min(STRETCH, loads - a)
        mask = F.shiftright("mask", a).bitwiseAND(F.lit((1 << n) - 1).cast("long"))
        part = occurs.select(*KEY, "hd", mask.alias("mask"), "never").join(held, [*KEY, "hd"]).select(*KEY, "hd", *PATTERN)
        got = materialize(_one_stretch(part, n), f"{work}/stretch{a}", codec=CODEC)
        more = inserted(got, n, first + a)
        rows = more if rows is None else rows.unionByName(more)
        held = got.select(*KEY, "hd", F.col("ends").alias("held"))
    return rows, held.select(*KEY, "hd", F.col("held").alias("ends"), F.lit(0).cast("long").alias("ins"))
