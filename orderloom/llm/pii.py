"""Personal data: candidate spans scored by gradient-boosted trees, on DataFrame and SQL functions alone.

Base patterns of the contract are always reported. High-recall generators propose many more spans, which
overlap; boosted trees judge each from its format and its context, never from the checks that made the
labels (digit sums, part ranges). Base spans are never added, so the trees learn from what can be: twins
of base spans, in their contexts, in formats that the base does not know (an address with "(at)", a phone without
its plus) and candidates whose text tells what they are, against other candidates off the base spans.
They learn from every such example, equal ones as one row of their weight, and thresholds are calibrated for each kind
on all held-out ones, twins in held-out contexts among them, so a kind whose scores cannot be trusted adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm import spans as S
from orderloom.llm.common import prepare, staged_once


@dataclass(frozen=True)
class Kind:
    """``base`` is the contract's pattern, ``wide`` the high-recall generator, ``hint`` words around it.

    ``twins`` rewrite a base span in other formats (pattern, replacement, ... one after the other); a wide
    match that holds ``telling`` is of this kind without a hint.
    """

    name: str
    base: str
    wide: str
    hint: str
    needs: str | None = None
    twins: tuple[tuple[str, ...], ...] = ()
    telling: str | None = None


# The contract's kinds. Possessive runs and the look behind (a match starts at its run's
# start, or where the last match ended) find the same matches without going back over long runs. Cards
# of fewer than twelve digits cannot pass, and no longer run of digits starts inside a shorter one.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+"
        r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}+){1,8}+",
        "mail|contact|write",
        needs="@",
        twins=(
            ("@", " (at) ", r"\.(?=[^()]*$)", " (dot) "),
            ("@", "(at)", r"\.(?=[^()]*$)", "(dot)"),
            ("@", " [at] ", r"\.(?=[^\[\]]*$)", " [dot] "),
        ),
        telling=r"[(\[]at[)\]].*[(\[]dot[)\]]",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
        "address|host|server|ip",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?[0-9]){11,}+",
        r"(?<![0-9])[0-9]{3,6}+(?:[ .-]?[0-9]{2,8}+){1,5}+",
        "card|visa|pay|account",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"(?<![0-9+(])[+(]{0,2}[0-9]{1,4}+[ ().-]{1,3}+[0-9]{2,4}+(?:[ ().-]{1,3}+[0-9]{2,5}+){1,4}+",
        "phone|call|tel|fax|mobile",
        needs="+",
        twins=((r"^\+", ""), (r"^\+[0-9]+[ .-]*", "")),
    ),
)
MARK = "[PII]"

#: Steps of a score: thresholds are told apart to this fineness, so that there are at most so many for each kind.
STEPS = 10_000
#: Values of a feature, larger ones being equal: what the trees can tell apart, and few enough for equal rows to combine.
BINS = 64
PRECISION = 0.99
LEAST_HELD_OUT = 30
CONTEXT = 24

FEATURES = (
    "kind", "length", "digits", "letters", "dots", "dashes", "blanks", "brackets",
    "runs", "first_run", "longest_run", "glued_before", "glued_after", "hinted", "capitals",
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digit sum of a card number (at most 19 digits) passes."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(
        F.filter(values, lambda d: d.isNotNull()),
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    digits = _digits(match)
    many = F.length(digits)
    if kind == "ip":
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            parts, lambda p: F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255
        )
    if kind == "card":
        return many.between(12, 19) & _luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return many.between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Labelled spans of the contract's kinds: leftmost matches without overlap, failing ones dropped."""
    found = []
    for rank, kind in enumerate(KINDS):
        needs = F.contains(text, F.lit(kind.needs)) if kind.needs else None
        spans = S.located(text, kind.base, S.matches(text, kind.base, needs))
        found.append(S.labelled(_passing(spans, kind.name), kind.name, rank).cast(S.LABELLED))
    return F.concat(*found)


def _passing(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _passes(kind, s["match"])) if kind != "email" else spans


_CANDIDATE = "array<struct<start:int,rank:int,end:int,kind:string,match:string,before:string,after:string>>"


def candidate_spans(text: Column) -> Column:
    """Spans of all wide generators with the text around them; spans of different kinds overlap."""
    found = []
    for rank, kind in enumerate(KINDS):
        needs = F.contains(text, F.lit("@")) | F.contains(F.lower(text), F.lit("at")) if kind.name == "email" else None
        spans = S.located(text, kind.wide, S.matches(text, kind.wide, needs), CONTEXT)
        found.append(_of_kind(spans, kind.name, rank).cast(_CANDIDATE))
    return F.concat(*found)


def _of_kind(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            *(s[x].alias(x) for x in ("match", "before", "after")),
        ),
    )


def _judged(found: DataFrame) -> DataFrame:
    """(_row, _key, c) of the candidates in rows (_row, _key, _base, _proposed), with ``label`` (a base span itself) and
    ``touching`` (it overlaps one).

    Of the base spans that begin before a candidate's end, the one that reaches furthest tells whether any overlaps
    it: a running maximum over a text's spans in order of place, however many there are.
    """
    held = found.where(F.size("_proposed") > 0)
    fields = [f"s.{x}" for x in ("start", "rank", "end", "kind")]
    base = held.select("_row", F.explode("_base").alias("s")).select(
        "_row", *fields, F.lit(1).alias("_is_base"), F.col("s.start").alias("_at"), F.col("s.end").alias("_to")
    )
    offered = held.select("_row", "_key", F.explode("_proposed").alias("s")).select(
        "_row", "_key", *fields, "s.match", "s.before", "s.after", F.lit(0).alias("_is_base"), F.col("s.end").alias("_at")
    )
    # at one place candidates stand first: a base span that begins where a candidate ends does not overlap it
    sweep = Window.partitionBy("_row").orderBy("_at", "_is_base").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    twin = Window.partitionBy("_row", "start", "end", "kind")
    events = offered.unionByName(base, allowMissingColumns=True)
    told = events.withColumn("_reach", F.max("_to").over(sweep)).withColumn("label", F.max("_is_base").over(twin) == 1)
    touching = F.coalesce(F.col("_reach") > F.col("start"), F.lit(False))
    return told.where("_is_base = 0").select(
        "_row",
        "_key",
        F.struct("start", "rank", "end", "kind", "match", "before", "after", "label", touching.alias("touching")).alias("c"),
    )


def _features(rows: DataFrame) -> DataFrame:
    """Features and labels of rows (_row, _key, c). ``_unsure``: off the base spans, well formed and with a hint before it.

    Such a candidate may well be personal data, so it is neither an example nor an error; what a hint means is learned
    from the contexts of base spans alone.
    """
    match, before, after = F.col("c.match"), F.col("c.before"), F.col("c.after")

    def many(pattern: str) -> Column:
        return F.length(F.regexp_replace(match, f"[^{pattern}]", ""))

    runs = F.filter(F.split(match, "[^0-9]+"), lambda r: r != "")
    sizes = F.transform(runs, lambda r: F.length(r))
    hinted, told, unsure = F.lit(False), F.lit(False), F.lit(False)
    for rank, kind in enumerate(KINDS):
        mine, passes = F.col("c.rank") == rank, _passes(kind.name, match)
        near = F.lower(before).rlike(f"\\b(?:{kind.hint})")
        tells = match.rlike(kind.telling) if kind.telling else F.lit(False)
        hinted = F.when(mine, near).otherwise(hinted)
        told = F.when(mine, tells & passes).otherwise(told)
        unsure = F.when(mine, near & passes & ~tells).otherwise(unsure)
    made = {
        "kind": F.col("c.rank"),
        "length": F.length(match),
        "digits": many("0-9"),
        "letters": many("A-Za-z"),
        "dots": many("."),
        "dashes": many("-"),
        "blanks": many(" "),
        "brackets": many("()"),
        "runs": F.size(runs),
        "first_run": F.coalesce(F.try_element_at(sizes, F.lit(1)), F.lit(0)),
        "longest_run": F.coalesce(F.array_max(sizes), F.lit(0)),
        "glued_before": before.rlike(r"[A-Za-z0-9+._-]$"),
        "glued_after": after.rlike("[A-Za-z0-9]"),
        "hinted": hinted,
        "capitals": many("A-Z"),
    }
    return rows.select(
        "_row", "_key", "c", (F.col("c.label") | told).cast("double").alias("_label"), F.col("c.touching").alias("_touching"),
        (unsure & ~F.col("c.label")).alias("_unsure"),
        *[F.least(F.coalesce(v.cast("double"), F.lit(0.0)), F.lit(BINS - 1.0)).alias(f"_f_{k}") for k, v in made.items()],
    )


def _twins(rows: DataFrame) -> DataFrame:
    """Rows like those of ``rows``: one for each base span that has another format, drawn by its place."""
    match, made = F.col("c.match"), F.lit(None).cast("string")
    for rank, kind in enumerate(KINDS):
        forms = []
        for steps in kind.twins:
            form = match
            for pattern, other in zip(steps[::2], steps[1::2], strict=True):
                form = F.regexp_replace(form, pattern, other)
            forms.append(form)
        if forms:
            form = F.element_at(F.array(*forms), F.pmod(F.hash("_key", "c.start"), F.lit(len(forms))) + 1)
            is_one = form.rlike(f"^(?:{kind.wide})$") & _passes(kind.name, form)
            made = F.when((F.col("c.rank") == rank) & is_one, form).otherwise(made)
    twins = rows.where(F.col("c.label")).select("_row", "_key", F.col("c").withField("match", made).alias("c"))
    twins = twins.where(F.col("c.match").isNotNull())
    return _features(twins.withColumn("c", F.col("c").withField("touching", F.lit(False))))


def _assembled(rows: DataFrame) -> DataFrame:
    columns = [f"_f_{k}" for k in FEATURES]
    return VectorAssembler(inputCols=columns, outputCol="_features").transform(rows).drop(*columns)


def _vectors(examples: DataFrame) -> DataFrame:
    """Examples with equal features, label, fold and touching as one row of weight ``_many``; they combine map-side."""
    columns = [f"_f_{k}" for k in FEATURES]
    return examples.groupBy(*columns, "_label", "_fold", "_touching").agg(F.count(F.lit(1)).cast("double").alias("_many"))


def train(examples: DataFrame) -> tuple[GBTClassificationModel, dict[str, int]] | None:
    """Boosted trees on four fifths of all examples, and each kind's threshold on all of the rest.

    ``examples`` are rows of ``_vectors``: every example counts, equal ones as one row of their weight. A threshold is
    the lowest ``_step`` of scores from which ``PRECISION`` of the held-out examples are personal data, base spans
    apart; a kind without one, or with too few held-out examples, gets none and adds nothing.
    """
    classes = {r["_label"]: r["n"] for r in examples.groupBy("_label").agg(F.sum("_many").alias("n")).collect()}
    if min(classes.get(0.0, 0), classes.get(1.0, 0)) < LEAST_HELD_OUT:
        return None
    rows = _assembled(examples.withColumn("_rank", F.col("_f_kind")))
    trees = GBTClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_many", maxIter=10, maxDepth=4, maxBins=BINS, seed=7
    )
    model = trees.fit(rows.where("_fold < 4"))
    held = scored(model, rows.where("_fold = 4 AND NOT _touching")).groupBy("_rank", "_step")
    steps = held.agg(F.sum("_many").alias("n"), F.sum(F.col("_many") * F.col("_label")).alias("right"))
    above = Window.partitionBy("_rank").orderBy(F.desc("_step"))  # at most STEPS + 1 rows for each of the kinds
    told = steps.select("_rank", "_step", F.sum("n").over(above).alias("n"), F.sum("right").over(above).alias("right"))
    good = told.where((F.col("n") >= LEAST_HELD_OUT) & (F.col("right") >= F.col("n") * PRECISION))
    best = {int(r["_rank"]): r["least"] for r in good.groupBy("_rank").agg(F.min("_step").alias("least")).collect()}
    return model, {kind.name: best[rank] for rank, kind in enumerate(KINDS) if rank in best}


def scored(model: GBTClassificationModel, assembled: DataFrame) -> DataFrame:
    made = model.transform(assembled).withColumn("_step", F.floor(vector_to_array("probability")[1] * STEPS))
    return made.drop("rawPrediction", "probability", "prediction", "_features")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, _base, _spans) of every row: the base spans, and these with what the trees add.

    Added spans overlap no base span. A null text is an empty one, without spans; ids may be null or
    repeat; other columns are not read; an empty table gives an empty result. Few candidates, or all of
    one class, train no trees: then the base spans are all.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("_id"), text.alias("_whole"))
    found = staged_once(
        read.select(
            F.monotonically_increasing_id().alias("_row"),
            F.xxhash64("_id", "_whole").alias("_key"),  # draws go by it, so they do not depend on partitions
            "_id",
            base_spans(F.col("_whole")).alias("_base"),
            candidate_spans(F.col("_whole")).alias("_proposed"),
        ),
        "pii-spans",
    )
    one = staged_once(_features(_judged(found)), "pii-candidates")
    examples = one.where((F.col("c.label") | ~F.col("_touching")) & ~F.col("_unsure")).unionByName(_twins(one))
    examples = examples.withColumn("_fold", F.pmod(F.hash("_key", F.lit(5)), F.lit(5)))
    trained = train(staged_once(_vectors(examples), "pii-examples"))
    if trained is None or not trained[1]:
        return found.select("_row", "_id", "_base", F.array_sort("_base").alias("_spans"))
    model, thresholds = trained
    least = F.lit(STEPS + 1)
    for kind, threshold in thresholds.items():
        least = F.when(F.col("c.kind") == kind, F.lit(threshold)).otherwise(least)
    judged = scored(model, _assembled(one.where(~F.col("_touching")))).where(F.col("_step") >= least)
    added = judged.select("_row", F.struct("c.start", "c.rank", "c.end", "c.kind").alias("s"))
    added = added.groupBy(F.col("_row").alias("_of")).agg(F.collect_list("s").alias("_added"))  # one text's spans
    joined = found.join(added, F.col("_row") == F.col("_of"), "left")
    spans = F.concat("_base", F.coalesce(F.col("_added").cast(S.LABELLED), F.array().cast(S.LABELLED)))
    return joined.select("_row", "_id", "_base", F.array_sort(spans).alias("_spans"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans, for every row."""
    spans = detect(docs, id_col, text_col)
    return spans.select(
        F.col("_id").alias(id_col),
        *[S.counted(F.col("_base"), kind.name).alias(f"n_{kind.name}") for kind in KINDS],
        F.sha2(S.listed(F.col("_base")), 256).alias("base_sha256"),
        S.listed(F.col("_spans")).alias("spans"),
    )
