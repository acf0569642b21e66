"""Quality rules: a learned decision list over document statistics.

Sequential covering: each round grows a conjunction of thresholds on the
labelled statistics, literal by literal by information gain, prunes it on rows
held back, and takes it into the list if it is precise enough there; rows it
covers are then set aside.  The list is emitted as one ordered CASE expression
(``as_column``) or its SQL text (``as_sql``).

Every step looks at all cuts between neighbouring values of the rows that are
still open to it, so no row is out of reach at the end of a range.

Statistics, thresholds, gains of every candidate literal and the final
verdicts are all built-in DataFrame functions.  The driver sees only the
literal of most gain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, cut_lineage, others

#: The statistics of the base rules, in their order.
BASE_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What thresholds are put on.
FEATURES = ["n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mark_rate"]


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """A column that is worked out once: no later filter or projection copies its expression past the generator."""
    return df.withColumn(name, F.explode(F.array(value)))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``__s``, a struct of the base statistics and the rates learned from. A null text counts as empty.

    n_repeat_words sorts the three-word windows of a text, by 128 bits of hashes,
    with their places; windows with an equal neighbour in that order are those
    found more than once.  In the order of their places each covers the words
    up to the next one, three at most.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    x = _once(docs, F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(1)), "__w")
    n = F.size("__w")
    word = lambda i: F.get("__w", i)
    window = lambda i: F.struct(*[F.xxhash64(F.lit(seed), word(i), word(i + 1), word(i + 2)).alias(h) for seed, h in ((1, "g"), (2, "h"))], i.alias("i"))
    x = _once(x, F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window))), "__z")
    same = lambda p, q: (p["g"] == q["g"]) & (p["h"] == q["h"])
    after = F.slice("__z", F.lit(2), F.greatest(F.size("__z") - 1, F.lit(0)))
    x = _once(x, F.when(n >= 4, F.zip_with("__z", after, lambda p, q: F.coalesce(same(p, q), F.lit(False)))), "__e")  # whether the next window is an equal one
    place = F.transform("__z", lambda w, k: F.when(F.get("__e", k) | F.coalesce(F.get("__e", k - 1), F.lit(False)), w["i"]))
    x = _once(x, F.when(n >= 4, F.sort_array(F.filter(place, lambda i: i.isNotNull()))), "__i")
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    more = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last"))
    covered = F.aggregate("__i", start, more, lambda a: a["n"])
    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(WORD))
    x = x.withColumn("__lines", lines)
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("long")
    stats = F.struct(
        n.cast("long").alias("n_words"),
        (F.length(t) - count(r"[\x20\x09-\x0D]")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 4, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        count(r"\p{Lu}").alias("n_upper"),
        count("[!?]").alias("n_marks"),
    )
    return _once(x, stats, "__s").drop("__w", "__z", "__e", "__i", "__lines")


def feature_columns(s: str = "__s") -> list[Column]:
    """The features as doubles, from the struct of statistics; rates of an empty text are 0."""
    rate = lambda a, b: F.when(F.col(f"{s}.{b}") > 0, F.col(f"{s}.{a}") / F.col(f"{s}.{b}")).otherwise(0.0)
    return [
        F.col(f"{s}.n_words").cast("double").alias("n_words"),
        rate("word_chars", "n_words").alias("mean_word"),
        rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("n_upper", "word_chars").alias("upper_rate"),
        rate("n_marks", "n_words").alias("mark_rate"),
    ]


def base_failed(s: str = "__s") -> Column:
    return (F.col(f"{s}.n_words") < 50) | (100 * F.col(f"{s}.n_repeat_words") > 50 * F.col(f"{s}.n_words"))


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def sql(self, prefix: str = "") -> str:
        return f"{prefix}{self.feature} {'>=' if self.above else '<'} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    literals: tuple[Literal, ...]
    covered: int
    precision: float

    def sql(self, prefix: str = "") -> str:
        return " AND ".join(x.sql(prefix) for x in self.literals)


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects a document, none keeps it."""

    rules: tuple[Rule, ...]

    def as_sql(self, prefix: str = "") -> str:
        """Number of the first rule that holds (from 1), 0 if none does."""
        if not self.rules:
            return "0"
        return "CASE " + " ".join(f"WHEN {r.sql(prefix)} THEN {i}" for i, r in enumerate(self.rules, 1)) + " ELSE 0 END"

    def as_column(self, prefix: str = "") -> Column:
        return F.expr(self.as_sql(prefix))


@dataclass(frozen=True)
class Learner:
    """max_labelled: labelled rows learned from, about (a share by hash of the id is taken beyond it)."""

    max_labelled: int = 20_000
    max_rules: int = 8
    max_literals: int = 3
    min_covered: int = 5
    min_precision: float = 0.9
    holdout: int = 3

    def labelled(self, docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
        known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.min(label).alias("__label"))
        total = known.count()
        share = F.crc32(F.concat(F.lit("sample:"), F.col("__id").cast("string")).cast("binary")) % 1_000_000
        if total > self.max_labelled:
            known = known.filter(share < int(1_000_000 * self.max_labelled / total))
        # At most about max_labelled pairs of an id and a label: bounded by the parameter.
        rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(known), "__id")
        rows = with_statistics(rows, "__text").filter(~base_failed())
        fold = F.crc32(F.concat(F.lit("fold:"), F.col("__id").cast("string")).cast("binary")) % self.holdout
        return cut_lineage(rows.select((F.col("__label") == 0).cast("int").alias("bad"), (fold == 0).alias("held"), *feature_columns()))

    def learn(self, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DecisionList:
        """The list of rules that reject documents like those labelled 0. Without labels of both kinds it is empty.

        Only labelled documents that pass the base rules are learned from. An id with several labels has the least.
        """
        rows = self.labelled(docs, labels, doc_id, text, label)
        rules: list[Rule] = []
        while len(rules) < self.max_rules:
            left = rows.filter(DecisionList(tuple(rules)).as_column() == 0)
            rule = self._prune(left, self._grow(left.filter(~F.col("held"))))
            if rule is None:
                break
            rules.append(rule)
        return DecisionList(tuple(rules))

    def _grow(self, rows: DataFrame) -> list[Literal]:
        literals: list[Literal] = []
        while len(literals) < self.max_literals:
            best = self._best(rows.filter(" AND ".join(x.sql() for x in literals)) if literals else rows)
            if best is None:
                break
            literals.append(best[0])
            if best[1] == 0:
                break
        return literals

    def _best(self, rows: DataFrame) -> tuple[Literal, int] | None:
        """The literal of most gain, with the kept documents it still covers. Equal gains go to the first feature, then the least cut.

        Cuts lie halfway between neighbouring values of the rows.  A feature's
        values go to one task; they are no more than the rows learned from.
        """
        values = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).alias("v")) for i, f in enumerate(FEATURES)])
        counts = rows.select("bad", F.explode(values).alias("x")).groupBy("x.f", "x.v").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        w = Window.partitionBy("f")
        up = w.orderBy("v")
        to = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = counts.select("f", "v", F.lead("v").over(up).alias("next"), *[F.sum(c).over(o).alias(c + s) for c in "pn" for o, s in ((to, "_low"), (w, "0"))])
        middle = (F.col("v") + F.col("next")) / 2
        # Between doubles without one in between the upper is the cut.
        cut = F.when(middle > F.col("v"), middle).otherwise(F.col("next")).alias("cut")
        sides = F.array(
            F.struct(F.lit(True).alias("above"), (F.col("p0") - F.col("p_low")).alias("p"), (F.col("n0") - F.col("n_low")).alias("n")),
            F.struct(F.lit(False).alias("above"), F.col("p_low").alias("p"), F.col("n_low").alias("n")),
        )
        x = x.filter("next IS NOT NULL AND p0 > 0 AND n0 > 0").select("f", cut, "p0", "n0", F.explode(sides).alias("s")).select("f", "cut", "p0", "n0", "s.*")
        share = lambda p, n: F.log2(F.col(p) / (F.col(p) + F.col(n)))
        x = x.filter((F.col("p") >= self.min_covered) & (F.col("p") > 0)).withColumn("gain", F.round(F.col("p") * (share("p", "n") - share("p0", "n0")), 9)).filter("gain > 0")
        best = x.agg(F.max_by(F.struct("f", "above", "cut", "n"), F.struct("gain", -F.col("f"), -F.col("cut"), "above")).alias("b")).first().b
        return (Literal(FEATURES[best.f], best.above, best.cut), best.n) if best else None

    def _prune(self, rows: DataFrame, literals: list[Literal]) -> Rule | None:
        """The beginning of the conjunction that does best on the rows held back, if precise enough over all rows."""
        if not literals:
            return None
        starts = [literals[:k] for k in range(1, len(literals) + 1)]
        sums = []
        for k, part in enumerate(starts):
            holds = F.expr(" AND ".join(x.sql() for x in part))
            for name, rest in (("held", F.col("held")), ("all", F.lit(True))):
                hit = holds & rest
                sums += [F.count_if(hit & (F.col("bad") == 1)).alias(f"p_{name}_{k}"), F.count_if(hit & (F.col("bad") == 0)).alias(f"n_{name}_{k}")]
        r = rows.agg(*sums).first()
        value = lambda k: ((r[f"p_held_{k}"] - r[f"n_held_{k}"]) / max(1, r[f"p_held_{k}"] + r[f"n_held_{k}"]), -k)
        k = max(range(len(starts)), key=value)
        p, n = r[f"p_all_{k}"], r[f"n_all_{k}"]
        if p < self.min_covered or p < self.min_precision * (p + n):
            return None
        return Rule(tuple(starts[k]), p + n, p / (p + n))


def judge(docs: DataFrame, rules: DecisionList, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the base statistics, base_failed, rule (number of the first that rejects, else 0) and kept.

    A null or empty text has no words and so fails the base rules.  Repeated
    rows are judged alike; columns that already bear the new names are
    replaced.
    """
    new = [*BASE_STATS, "base_failed", "rule", "kept"]
    kept = others(docs, keep, new)
    own = [F.col(f"`{c}`").alias(f"__own{i}") for i, c in enumerate(kept)]  # so that no name of theirs clashes with one in between
    x = with_statistics(docs.select(*own, F.col(text).alias("__text")), "__text").drop("__text")
    x = x.withColumn("__f", F.struct(*feature_columns()))
    x = x.select(*[F.col(f"__own{i}").alias(c) for i, c in enumerate(kept)], *[F.col(f"__s.{c}").alias(c) for c in BASE_STATS], base_failed().alias("base_failed"), rules.as_column("__f.").alias("rule"))
    return x.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
