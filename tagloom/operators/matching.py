"""Joins of predictions and truth: by code, by time and place, one to one, by name."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.codes import barcode_match
from tagloom.functions.geometry import iou
from tagloom.functions.text import squeeze
from tagloom.session import cut_lineage

#: More than the rounding error of a length times or over a score.
ROUNDING = 1e-6


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, most: float) -> DataFrame:
    """Pairs with equal keys whose times differ by ``most`` at most.

    Times fall into slots of the width ``most``; the right side is repeated
    into its slot and both neighbours, so the join is an equi-join on keys and
    slot with a residual filter, and finds each pair once.
    """
    slot = lambda c: F.floor(F.col(c) / F.lit(most)).cast("long")
    a = left.withColumn("__slot", slot(left_time))
    b = right.withColumn("__slot", F.explode(F.array(*[slot(right_time) + i for i in (-1, 0, 1)])))
    return a.join(b, [*keys, "__slot"]).filter(F.abs(F.col(left_time) - F.col(right_time)) <= most).drop("__slot")


def place_join(pred: DataFrame, truth: DataFrame, keys: list[str], most_ms: float = 1500, least_iou: float = 0.3) -> DataFrame:
    """Pairs near in time (p_ts, g_ts) whose boxes (p_x1.., g_x1..) overlap enough; both bounds belong to it."""
    box = lambda s: tuple(F.col(f"{s}_{c}") for c in ("x1", "y1", "x2", "y2"))
    near = interval_join(pred, truth, keys, "p_ts", "g_ts", most_ms)
    return near.withColumn("iou", iou(box("p"), box("g"))).filter(F.col("iou") >= least_iou)


#: True codes of a group that each of its predictions is compared with.
FEW_CODES = 128


def _left_over(codes: DataFrame, keys: list[str], code: str, text: Column, length: int, cuts: int, tag: str) -> DataFrame:
    """(keys, code, __left): a hash of the tag and of each text that is left of a text of the given length without ``cuts`` of its characters."""
    x = codes.select(*keys, code, text.alias("__c"))
    places = [c for c in combinations(range(1, length + 1), cuts)]
    x = x.withColumn("__at", F.explode(F.array(*[F.struct(*[F.lit(i).alias(f"x{k}") for k, i in enumerate(c)], F.lit(length + 1).alias("end")) for c in places])))
    ends = [F.lit(0), *[F.col(f"__at.x{k}") for k in range(cuts)], F.col("__at.end")]
    left = F.concat(*[F.substring("__c", a + 1, b - a - 1) for a, b in pairwise(ends)])
    return x.select(*keys, code, F.xxhash64(F.lit(tag), left).alias("__left"))


def code_join(pred: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of the same keys whose codes match; the predicted code must have 13 digits.

    Codes are compared once each.  Where a group (a video) has no more than
    FEW_CODES true ones, a prediction is compared with all of them, which is
    fewer than the rows it would be repeated for; in larger groups by what is
    left of both:  Two texts within an edit distance of two have all but two characters of the
    longer one in common, in the same order; so one that leaves out just so many
    of each in every way has an equal result on both sides.  Only codes and
    hashes of these results go through the equi-join.  What is left has eleven digits or more, so a prefix that many
    codes share makes no hot key.  Codes of other lengths are also compared by
    up to ten characters at either end, in the same way.  Which lengths there
    are on the true side is asked first; predictions are only shortened to what
    these call for.
    """
    p = cut_lineage(pred.filter(F.col("p_code").rlike(r"^[0-9]{13}\z")).select(*keys, "p_code").distinct())
    # A code shorter than eight is more than two edits from 13 digits, and has no end of eight.
    g = cut_lineage(truth.filter(F.length("g_code") >= 8).select(*keys, "g_code").distinct())
    few = cut_lineage(g.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).select(*keys, (F.col("__n") <= FEW_CODES).alias("__few")))
    p, g = p.join(few, keys), g.join(few, keys)
    near = p.filter("__few").drop("__few").join(g.filter("__few").drop("__few"), keys).filter(barcode_match(F.col("p_code"), F.col("g_code")))
    p, g = p.filter("NOT __few").drop("__few"), g.filter("NOT __few").drop("__few")
    lengths = {r.n for r in g.select(F.least(F.length("g_code"), F.lit(16)).alias("n")).distinct().collect()}  # nine at most

    ours, theirs = [], []
    for longest in (13, 14, 15):
        these = sorted(n for n in lengths if (11 <= n <= 13 if longest == 13 else n == longest))
        if these:
            ours.append(_left_over(p, keys, "p_code", F.col("p_code"), 13, 15 - longest, f"{longest}"))
        for n in these:
            theirs.append(_left_over(g.filter(F.length("g_code") == n), keys, "g_code", F.col("g_code"), n, n - longest + 2, f"{longest}"))
    other = g.filter(F.length("g_code") != 13)
    for n in sorted({min(n, 10) for n in lengths if n != 13}):
        same = other.filter(F.least(F.length("g_code"), F.lit(10)) == n)
        for side, cut in (("l", F.left), ("r", F.right)):
            ours.append(_left_over(p, keys, "p_code", cut(F.col("p_code"), F.lit(n)), n, 2, f"{side}{n}"))
            theirs.append(_left_over(same, keys, "g_code", cut(F.col("g_code"), F.lit(n)), n, 2, f"{side}{n}"))
    if ours:
        found = reduce(DataFrame.unionAll, ours).join(reduce(DataFrame.unionAll, theirs), [*keys, "__left"])
        found = found.select(*keys, "p_code", "g_code").distinct().filter(barcode_match(F.col("p_code"), F.col("g_code")))
        near = near.select(*keys, "p_code", "g_code").unionAll(found)
    both = near.join(pred, [*keys, "p_code"]).join(truth, [*keys, "g_code"])
    return both.select(*keys, *[c for c in pred.columns if c not in keys], *[c for c in truth.columns if c not in keys])


def greedy_match(edges: DataFrame, keys: list[str], pred: str = "p_ord", truth: str = "g_ord", rule: str = "rule", stream_edges: int = 1_000_000, rounds: int = 40) -> DataFrame:
    """(keys, pred, truth, rule): predictions in order take their first unused truth, by rule, then order.

    Groups (videos) of up to ``stream_edges`` edges are dealt to tasks and
    sorted there; one pass over the stream of edges holds only which truths of
    the group are taken.  Larger groups are settled in rounds of joins first,
    spread over all tasks: a prediction whose first free truth no earlier
    prediction can still ask for is sure to get it, so it is matched, and the
    edges of both go.  The first prediction is always among these, and where
    predictions compete for different truths most are.  A group that has shrunk
    to the bound is streamed with the rest, as is what is left after ``rounds``.
    """
    named = [*keys, pred, truth, rule]
    rows = cut_lineage(edges.select(*named))
    group = [f"__k{i}" for i in range(len(keys))]
    same = lambda df: reduce(Column.__and__, [F.col(k).eqNullSafe(df[n]) for k, n in zip(keys, group)])
    above = lambda df: df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, group)]).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > stream_edges).drop("__n")
    large = cut_lineage(above(rows))
    done: list[DataFrame] = []
    if large.isEmpty():
        small = rows
    else:
        small = rows.join(large, same(large), "left_anti")
        live = cut_lineage(rows.join(large, same(large), "left_semi"))
        for _ in range(rounds):
            if live.isEmpty():
                break
            ask = live.groupBy(*keys, pred).agg(F.min(F.struct(rule, truth)).alias("__first")).select(*keys, pred, F.col(f"__first.{truth}").alias(truth), F.col(f"__first.{rule}").alias(rule))
            ask, least = ask.select(*[F.col(c).alias(f"__a{i}") for i, c in enumerate(named)]), live.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, group)], F.col(truth).alias("__g")).agg(F.min(pred).alias("__p"))
            on = reduce(Column.__and__, [F.col(f"__a{i}").eqNullSafe(F.col(n)) for i, n in enumerate(group)])
            k = len(keys)
            sure = cut_lineage(ask.join(least, on & (F.col(f"__a{k + 1}") == F.col("__g")) & (F.col(f"__a{k}") == F.col("__p"))).select(*[f"__a{i}" for i in range(len(named))]))
            done.append(sure.select(*[F.col(f"__a{i}").alias(c) for i, c in enumerate(named)]))
            own = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__a{i}")) for i, c in enumerate(keys)])
            live = live.join(sure, own & (F.col(pred) == F.col(f"__a{k}")), "left_anti").join(sure, own & (F.col(truth) == F.col(f"__a{k + 1}")), "left_anti")
            live = cut_lineage(live)
            if above(live).isEmpty():
                break
        small = small.unionAll(live)
    dealt = small.repartition(*keys).sortWithinPartitions(*keys, pred, rule, truth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, used, last = None, set(), None
        for batch in batches:
            take = []
            for i, (*key, p, g) in enumerate(zip(*[batch[c].to_pylist() for c in [*keys, pred, truth]])):
                if key != group:
                    group, used, last = key, set(), None
                if (last is None or p != last) and g not in used:
                    last = p
                    used.add(g)
                    take.append(i)
            if take:
                yield batch.take(pa.array(take))

    return reduce(DataFrame.unionAll, done, dealt.mapInArrow(run, dealt.schema))


def _classes(norm: Column) -> Column:
    """(low, high): a bit for each of the first four characters of each of 32 classes of characters.

    An edit takes away one character of a class at most and adds one, so the
    bits that one text has and another hasn't are no more than their edit
    distance.
    """
    sorted_ = F.sort_array(F.transform(F.split(norm, ""), lambda c: F.pmod(F.xxhash64(c), F.lit(32)).cast("int")))
    none = F.lit(0).cast("long")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), none.alias("low"), none.alias("high"))

    def add(a: Column, c: Column) -> Column:
        run = F.when(c == a["last"], a["run"] + 1).otherwise(0)
        bit = F.when(run < 4, F.call_function("shiftleft", F.lit(1).cast("long"), (c % 16) * 4 + run)).otherwise(none)
        return F.struct(c.alias("last"), run.alias("run"), F.when(c < 16, a["low"].bitwiseOR(bit)).otherwise(a["low"]).alias("low"), F.when(c >= 16, a["high"].bitwiseOR(bit)).otherwise(a["high"]).alias("high"))

    return F.aggregate(sorted_, start, add, lambda a: F.struct(a["low"].alias("low"), a["high"].alias("high")))


def _measured(rows: DataFrame, text: str, pivots: list[str]) -> DataFrame:
    """Adds length, classes and distances to the pivots of a squeezed text, by the text's letter."""
    x = rows.withColumn(f"{text}_len", F.length(text)).withColumn(f"{text}_bits", _classes(F.col(text)))
    return x.withColumns({f"{text}_p{i}": F.levenshtein(F.col(text), F.lit(p)) for i, p in enumerate(pivots)})


def _trigrams(text: str) -> Column:
    padded = F.concat(F.lit("  "), text, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


#: Width of a cell of distances to the first pivot; entries that a rare part is looked for among, and parts of a name.
CELL, RARE, PARTS = 4, 64, 2


def name_pairs(names: DataFrame, gallery: DataFrame, least: float) -> DataFrame:
    """(name, q, ord, entry, g, most): pairs whose edit distance has to be worked out; no other can be a name's best.

    Edit distance is a metric, and three bounds on it are cheap: lengths,
    distances to two far-apart entries (pivots), and characters by class.  How
    far a name has to look is known from the best of a few entries that share
    its rarest parts of three characters, if it has such.  With that reach a
    name is repeated for the lengths and the cells of distances to the first
    pivot that it covers, and joins the entries there; the other bounds are
    filters of the join.  The reach includes the distance of the entry found,
    so that equals are compared too.
    """
    g = gallery.select(F.col("ord"), F.col("entry"), squeeze(F.col("entry")).alias("g")).filter("g <> ''")
    far = g.agg(F.min_by("g", "ord").alias("a")).first().a
    second = g.agg(F.max_by("g", F.struct(F.levenshtein(F.col("g"), F.lit(far or "")), F.col("g"))).alias("b")).first().b
    pivots = [far or "", second or ""]
    g = cut_lineage(_measured(g, "g", pivots))
    n = names.select(F.col("name"), squeeze(F.col("name")).alias("q")).filter("q <> ''")
    n = cut_lineage(_measured(n, "q", pivots))

    parts = g.select("ord", "g", "g_len", F.explode(_trigrams("g")).alias("part"))
    rare = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= RARE)
    own = n.select("name", "q", "q_len", F.explode(_trigrams("q")).alias("part")).join(rare, "part")
    own = own.groupBy("name", "q", "q_len").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "part"))), 1, PARTS).alias("p")).select("name", "q", "q_len", F.explode("p.part").alias("part"))
    near = own.join(parts.join(rare, "part", "left_semi"), "part")
    score = 1.0 - F.levenshtein(F.col("q"), F.col("g")) / F.greatest("q_len", "g_len")
    found = near.groupBy("name").agg(F.max(score).alias("found"))

    x = n.join(found, "name", "left").withColumn("found", F.greatest(F.coalesce("found", F.lit(least)), F.lit(least)))
    low, high = F.ceil(F.col("q_len") * F.col("found") - ROUNDING).cast("int"), F.floor(F.col("q_len") / F.col("found") + ROUNDING).cast("int")
    x = x.withColumn("g_len", F.explode(F.sequence(F.greatest(low, F.lit(1)), F.greatest(high, F.lit(1)))))
    x = x.withColumn("most", F.floor((1 - F.col("found")) * F.greatest("q_len", "g_len") + ROUNDING).cast("int"))
    cell = lambda c: F.floor(c / CELL).cast("int")
    x = x.withColumn("cell", F.explode(F.sequence(cell(F.col("q_p0") - F.col("most")), cell(F.col("q_p0") + F.col("most")))))
    both = x.join(g.withColumn("cell", cell(F.col("g_p0"))), ["g_len", "cell"])
    within = [F.abs(F.col(f"q_p{i}") - F.col(f"g_p{i}")) <= F.col("most") for i in range(len(pivots))]
    more = lambda a, b: sum((F.bit_count(F.col(f"{a}_bits.{h}").bitwiseAND(F.bitwise_not(F.col(f"{b}_bits.{h}")))) for h in ("low", "high")), F.lit(0))
    within += [more(a, b) <= F.col("most") for a, b in ("qg", "gq")]
    return both.filter(reduce(Column.__and__, within)).select("name", "q", "ord", "entry", "g", "most")


def match_names(names: DataFrame, gallery: DataFrame, name: str = "name", least: float = 0.55) -> DataFrame:
    """(name, canonical, score): the most similar gallery entry, the first of equals; the name itself below ``least``.

    ``gallery`` has (ord, entry).  Names are compared once each, with the
    entries that ``name_pairs`` leaves; the score decides.  ``least`` must be
    over 0.  A null or blank name, or an empty gallery, gives the name itself.
    """
    once = cut_lineage(names.select(F.col(name).alias("name")).distinct())
    pairs = name_pairs(once, gallery, least)
    distance = F.call_function("levenshtein", F.col("q"), F.col("g"), F.col("most"))
    scored = pairs.withColumn("d", distance).filter("d >= 0").withColumn("score", 1.0 - F.col("d") / F.greatest(F.length("q"), F.length("g"))).filter(F.col("score") >= least)
    best = scored.groupBy(F.col("name").alias("__name")).agg(F.max_by(F.struct("entry", "score"), F.struct("score", -F.col("ord"))).alias("b"))
    return once.join(best, F.col("name") == F.col("__name"), "left").select("name", F.coalesce("b.entry", "name").alias("canonical"), F.coalesce("b.score", F.lit(0.0)).alias("score"))


def artifact_join(rows: DataFrame, artifacts: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Rows with the columns of the artifact of the same keys, the last by ``order``; blanks where there is none."""
    down = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    last = artifacts.withColumn("__n", F.row_number().over(down)).filter("__n = 1").select(*keys, *columns)
    return rows.join(last, keys, "left").withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def resolve_files(rows: DataFrame, files: DataFrame, folder: str, name: str, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Rows with ``found``: folder/name, else folder/basename, else null; and (found, missing) counts."""
    f = files.select(F.col(path).alias("__path")).distinct()
    whole, base = F.concat_ws("/", F.col(folder), F.col(name)), F.concat_ws("/", F.col(folder), F.element_at(F.split(F.col(name), "/"), -1))
    x = rows.withColumn("__a", whole).withColumn("__b", base)
    x = x.join(f.withColumnRenamed("__path", "__p1"), F.col("__a") == F.col("__p1"), "left").join(f.withColumnRenamed("__path", "__p2"), F.col("__b") == F.col("__p2"), "left")
    out = x.withColumn("found", F.coalesce("__p1", "__p2")).drop("__a", "__b", "__p1", "__p2")
    return out, out.agg(F.count("found").alias("found"), F.count_if(F.col("found").isNull()).alias("missing"))


def having_label(images: DataFrame, labels: DataFrame, key: str = "stem") -> DataFrame:
    return images.join(labels.select(key).distinct(), key, "left_semi")


def without_file(tasks: DataFrame, files: DataFrame, key: str) -> DataFrame:
    return tasks.join(files.select(key).distinct(), key, "left_anti")


def prefer(rows: DataFrame, keys: list[str], kind: str, order: list[str], then: str) -> DataFrame:
    """One row per key: the first kind in ``order`` that there is, then by name. Other kinds are left out."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(kind))
    w = Window.partitionBy(*keys).orderBy(rank, then)
    return rows.filter(rank > 0).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def matching_edges(by_code: DataFrame, by_place: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate edges of both rules: 1 by code, 2 by place."""
    take = lambda df, n: df.select(*keys, "p_ord", "g_ord", F.lit(n).alias("rule"))
    return take(by_code, 1).unionByName(take(by_place, 2))
