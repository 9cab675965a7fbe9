"""URL filter: longest-match host and path rules, then gradient-boosted trees on lexical features.

The trees (Spark ML's GBTClassifier, all on the JVM) are fitted on labelled URLs: a
bounded sample of ``sample_rows`` rows, chosen by a hash of the URL from all rows. Labels are
given by the caller, or else by ``weak_labels``: the verdict of a rule that fits, else
``block`` when the host holds a term of a fixed list, else ``allow``. Features see no
terms, only shape: lengths, depth, digit and hyphen shares, character entropy,
parameter counts, and the smoothed share of blocked URLs per host suffix and per
suffix with first path segment (statistics of the sample; a row
of the sample gets those of the half that it is not in).

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is allowed; an empty table gives an empty result; if the sample holds one label
only, that label is the verdict of every URL without a rule; repeated rows get repeated
rows; extra columns are ignored. Rules of equal length: the first in the given order wins.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import table

#: Fixed rules: (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Fixed terms that label a host as unwanted when no rule fits.
TERMS = ("ads-", "adult", "bets", "casino", "pills", "spam", "porn", "poker", "viagra")
SAMPLE_ROWS = 10_000
TREES, DEPTH = 12, 4
FEATURES = ("url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_share", "hyphens",
            "longest_label", "entropy", "host_entropy", "parameters", "has_fragment", "is_https", "suffix_block",
            "segment_block", "suffix_seen")


def split(urls: DataFrame) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": host, "path": path})


def with_rule(parts: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (host and path of the longest rule that fits, else null) and ``rule_verdict``."""
    def fits(host: str, path: str) -> Column:
        at = F.col("host") == host if host else F.lit(False)
        return (at | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)

    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))    # stable: ties keep the given order
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in reversed(longest):
        rule = F.when(fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits(host, path), F.lit(what)).otherwise(verdict)
    return parts.withColumns({"rule": rule, "rule_verdict": verdict})


def entropy(text: Column) -> Column:
    """Shannon entropy in bits of the characters of a string."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.greatest(F.size(letters), F.lit(1)).cast("double")
    return -F.aggregate(
        F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)).cast("double") / n),
        F.lit(0.0), lambda s, p: s + p * F.log2(p))


def with_lexical(parts: DataFrame) -> DataFrame:
    """Adds the shape features, the host suffix and the suffix with the first path segment."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    suffix = F.substring_index("host", ".", -1)
    return parts.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "query_length": F.length(query).cast("double"),
        "depth": (F.size(F.split("path", "/")) - 1).cast("double"), "labels": F.size(labels).cast("double"),
        "digit_share": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "longest_label": F.array_max(F.transform(labels, F.length)).cast("double"),
        "entropy": entropy(url), "host_entropy": entropy(F.col("host")),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"), "is_https": F.startswith(url, F.lit("https:")).cast("double"),
        "suffix": suffix, "segment": F.concat_ws("/", suffix, F.regexp_extract("path", r"(?s)^/([^/]*)", 1))})


def weak_labels(parts: DataFrame, terms=TERMS) -> Column:
    """1 for block, 0 for allow."""
    bad = F.lit(False)
    for term in terms:
        bad = bad | F.contains("host", F.lit(term))
    return F.coalesce((F.col("rule_verdict") == "block").cast("double"), bad.cast("double"))


def suffix_statistics(labelled: DataFrame, key: str, *more: str) -> DataFrame:
    """Smoothed share of blocked URLs and their number per value of ``key``; at most a row per sampled URL."""
    return labelled.groupBy(F.col(key).alias(f"{key}_key"), *more).agg(
        ((F.sum("label") + 1) / (F.count("*") + 2)).alias(f"{key}_block"), F.log1p(F.count("*").cast("double")).alias(f"{key}_seen"))


def with_statistics(rows: DataFrame, statistics: dict[str, DataFrame], *more: str) -> DataFrame:
    for key, frame in statistics.items():
        met = rows[key] == frame[f"{key}_key"]
        for c in more:
            met = met & (rows[c] == frame[f"_{c}"])
        rows = rows.join(F.broadcast(frame), met, "left") \
            .withColumns({f"{key}_block": F.coalesce(f"{key}_block", F.lit(0.5)),
                          f"{key}_seen": F.coalesce(f"{key}_seen", F.lit(0.0))}).drop(f"{key}_key", *[f"_{c}" for c in more])
    return rows


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS,
          trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``model_verdict`` of every row.

    ``labelled``: rows (``url``, ``label`` 0 or 1) to fit on; default: the rows of ``pages`` by ``weak_labels``.
    """
    rows = with_lexical(with_rule(split(pages.select(F.col("page_id").cast("long"), "url")), rules))
    if labelled is None:
        known = rows.withColumn("label", weak_labels(rows)).where("host <> ''")
    else:
        known = with_lexical(with_rule(split(labelled.select("url", F.col("label").cast("double"))), rules)).where("host <> ''")
    total = known.count()
    share = min(1.0, sample_rows / max(total, 1))
    order = F.xxhash64("url", F.lit(3))
    chosen = table(known.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(order, "url")
                   .limit(2 * sample_rows).drop("page_id").withColumn("half", F.pmod(F.xxhash64("url", F.lit(4)), F.lit(2))), "url-sample")
    statistics = {key: table(suffix_statistics(chosen, key), f"url-{key}") for key in ("suffix", "segment")}
    # a fitted row gets the statistics of the other half of the sample, never of its own label
    halves = {key: table(suffix_statistics(chosen, key, "half").withColumn("_half", 1 - F.col("half")).drop("half"),
                         f"url-{key}-halves") for key in ("suffix", "segment")}
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    labels = [r["label"] for r in chosen.select("label").distinct().collect()]
    told = with_statistics(rows, statistics)
    if len(labels) < 2:
        only = "block" if labels == [1.0] else "allow"
        told = told.withColumn("model_verdict", F.lit(only))
    else:
        fitted = table(assembler.transform(with_statistics(chosen, halves, "half")).select("features", "label")
                       .repartition(4), "url-features")
        model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3, seed=5).fit(fitted)
        told = model.transform(assembler.transform(told)) \
            .withColumn("model_verdict", F.when(F.col("prediction") == 1, "block").otherwise("allow"))
    verdict = F.coalesce("rule_verdict", F.when(F.col("host") == "", "allow"), F.col("model_verdict"))
    return told.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "model_verdict")
