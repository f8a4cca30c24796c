"""Secret scans through a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams. The index holds, for every trigram
that some query names, the documents it occurs in; intersecting postings leaves candidate documents,
and only these are searched with the rule's expression. Rules without mandatory trigrams scan all texts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import spans as S
from orderloom.llm.common import prepare, staged_once
from orderloom.llm.trigrams import query_of


@dataclass(frozen=True)
class Rule:
    """``least``: characters that ``group`` of a match must have; shorter matches are dropped, not retried.

    ``whole`` matches all that is secret where ``pattern``, which the scan reports, is only where it begins.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False
    whole: str | None = None


# The kinds of the scan's contract, then public credential formats. Runs that are too short
# cannot match for ``access`` and ``hex``: no match that is long enough starts inside one that is not.
RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"\bxox[abprs]-[0-9A-Za-z-]{10,250}"),
    Rule("google", r"\bAIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"\b[rs]k_live_[0-9A-Za-z]{16,250}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # to the END line, or without one (before any other line of dashes) to the end of the base64 lines
    Rule(
        "pem",
        r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
        whole=r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
        r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
        r"|(?:(?:\s|\\[rn])*+(?:Proc-Type|DEK-Info):\x20[^\s\\]++)*+"
        r"(?:(?:\s|\\[rn])*+[A-Za-z0-9+/]{16,}+={0,2})*+"
        r"(?:(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+[A-Za-z0-9+/]++={0,2}(?=[\x20\t]*+(?:[\r\n\\\"']|\Z)))?+)",
    ),
)
MASKED = tuple(replace(r, pattern=r.whole) if r.whole else r for r in RULES)
MARK = "[SECRET]"


def _found(text: Column, rule: Rule) -> Column:
    found = S.located(text, rule.pattern, S.matches(text, rule.pattern))
    if rule.least:
        found = F.filter(
            found, lambda s: F.length(F.regexp_extract(s["match"], rule.pattern, rule.group)) >= rule.least
        )
    return found


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows told apart by content: rows alike in id and text have the same findings."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.xxhash64(F.col(id_col), text).alias("_k1"),
        F.xxhash64(text, F.lit(1), F.col(id_col)).alias("_k2"),
        F.col(id_col).alias("_id"),
        text.alias("_whole"),
    )


def index(keyed: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Postings (_trigram, _k1, _k2): the documents in which each trigram of the vocabulary occurs."""
    lower = keyed.select("_k1", "_k2", F.lower("_whole").alias("_lower"))
    present = F.filter(F.array(*map(F.lit, vocabulary)), lambda t: F.contains(F.col("_lower"), t))
    return lower.select(F.explode(present).alias("_trigram"), "_k1", "_k2")


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(_k1, _k2, _rules): documents whose postings satisfy the rules' queries, intersected on Spark."""
    spark = postings.sparkSession
    asked = [
        (name, k, trigram, 1 << bit, (1 << len(alternative)) - 1)
        for name, query in queries.items()
        for k, alternative in enumerate(query)
        for bit, trigram in enumerate(sorted(alternative))
    ]
    asked = spark.createDataFrame(asked, "_rule string, _alternative int, _asked string, _bit long, _all long")
    joined = postings.join(F.broadcast(asked), F.col("_trigram") == F.col("_asked"))  # the fixed rules' trigrams
    met = (
        joined.groupBy("_k1", "_k2", "_rule", "_alternative")
        .agg(F.bit_or("_bit").alias("_met"), F.first("_all").alias("_all"))
        .where("_met = _all")
    )
    return met.groupBy("_k1", "_k2").agg(F.collect_set("_rule").alias("_rules"))  # as many as there are rules


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(_k1, _k2, _id, _spans) of every row: spans (start, rank, end, kind) of all rules' matches.

    A null text is an empty one, without findings; ids may be null or repeat; other columns are not read;
    an empty table gives an empty result. Spans of different rules may overlap.
    """
    prepare(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    queries = {r.name: query_of(r.pattern) for r in rules}
    indexed = {name: query for name, query in queries.items() if all(query)}

    def all_of(some: list[Rule], chosen: bool) -> Column:
        text, nothing = F.col("_whole"), F.array().cast(S.LABELLED)
        parts = [S.labelled(_found(text, r), r.name, rules.index(r)).cast(S.LABELLED) for r in some]
        if chosen:
            parts = [F.when(F.array_contains("_rules", r.name), p).otherwise(nothing) for r, p in zip(some, parts, strict=True)]
        return F.concat(nothing, *parts)

    full = keyed.select("_k1", "_k2", "_id", all_of([r for r in rules if r.name not in indexed], False).alias("_spans"))
    if not indexed:
        return full
    vocabulary = sorted({t for query in indexed.values() for a in query for t in a})
    postings = staged_once(index(keyed, vocabulary), "postings")
    chosen = staged_once(candidates(postings, indexed), "candidates").withColumnsRenamed({"_k1": "_c1", "_k2": "_c2"})
    verified = keyed.join(chosen, (F.col("_k1") == F.col("_c1")) & (F.col("_k2") == F.col("_c2")))
    verified = verified.select("_c1", "_c2", all_of([r for r in rules if r.name in indexed], True).alias("_more"))
    verified = staged_once(verified.where(F.size("_more") > 0), "verified").dropDuplicates(["_c1", "_c2"])
    joined = full.join(verified, (F.col("_k1") == F.col("_c1")) & (F.col("_k2") == F.col("_c2")), "left")
    more = F.coalesce(F.col("_more"), F.array().cast(S.LABELLED))
    return joined.select("_k1", "_k2", "_id", F.array_sort(F.concat("_spans", more)).alias("_spans"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each base kind, the digest of the base spans and all spans, for every row."""
    base = [r.name for r in RULES if r.base]
    spans = scan(docs, id_col, text_col)
    only = F.filter("_spans", lambda s: s["kind"].isin(base))
    return spans.select(
        F.col("_id").alias(id_col),
        *[S.counted(F.col("_spans"), name).alias(f"n_{name}") for name in base],
        F.sha2(S.listed(only), 256).alias("base_sha256"),
        S.listed(F.col("_spans")).alias("spans"),
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with every secret in the text replaced by a mark; a null text stays null."""
    found = staged_once(scan(docs, id_col, text_col, MASKED).where(F.size("_spans") > 0), "secrets").dropDuplicates(["_k1", "_k2"])
    found = found.select(*[F.col(c).alias(f"__llm{c}") for c in ("_k1", "_k2", "_spans")])
    text = F.coalesce(F.col(text_col), F.lit(""))
    key1, key2 = F.xxhash64(F.col(id_col), text), F.xxhash64(text, F.lit(1), F.col(id_col))
    joined = docs.withColumns({"__llm_key1": key1, "__llm_key2": key2}).join(
        found, (F.col("__llm_key1") == F.col("__llm_k1")) & (F.col("__llm_key2") == F.col("__llm_k2")), "left"
    )
    spans = F.col("__llm_spans")
    safe = F.when(spans.isNotNull(), S.redacted(F.col(text_col), spans, MARK)).otherwise(F.col(text_col))
    return joined.withColumn(text_col, safe).select(*docs.columns)
