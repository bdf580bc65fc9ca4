"""URL filter: host and path rules, and gradient-boosted trees for the rest.

A rule names a host and a path prefix; it fits that host and its subdomains
where the path begins with the prefix, and of several that fit the longest wins.
URLs that no rule fits are judged by boosted trees on lexical features: lengths,
path depth, digit ratios, entropy of the host's letters, parameters, hyphens,
labels, and for each of the host's suffixes the smoothed share of blocked URLs
among the labelled ones (held back from half of the hosts in fitting, as unseen
hosts have none).

The trees are fitted on a bounded sample of labelled URLs (``per_class`` of each
label, first by hash).  Where no labelled table is given, ``seed_labels`` labels
URLs by a stated list of words that blocked hosts carry.

Only DataFrame functions and Spark ML are used.  A null URL, or one without
``://``, has an empty host and path, fits no rule, and is judged by the trees
like any other; repeated URLs get equal verdicts; with labels of one kind only,
that label is the verdict, and with none every URL is allowed.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import pin

PER_CLASS = 5000
SMOOTH = 20
# Words of hosts that public block lists cover (gambling, adult, pharmacy, advertising, spam).
BLOCKED_WORDS = ("ads", "adult", "bet", "bets", "casino", "cheap", "loan", "loans", "pill", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "viagra", "xxx")

FEATURES = ["url_length", "host_length", "path_length", "depth", "digit_ratio", "host_digit_ratio", "host_entropy", "parameters", "hyphens",
            "labels", "longest_label", "has_fragment", "secure", "rate1", "rate2", "rate3"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(url.contains("://"), F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null; rules: (host, path prefix, verdict)."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):        # the last test is the outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def features(urls: DataFrame) -> DataFrame:
    """``urls`` (columns url, host, path) with the lexical features and the host's suffixes."""
    url = F.coalesce("url", F.lit(""))
    share = lambda text, kind: F.length(F.regexp_replace(text, f"[^{kind}]", "")) / F.greatest(F.length(text), F.lit(1))
    letters = F.split("host", "")
    entropy = F.aggregate(F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)) / F.greatest(F.size(letters), F.lit(1))),
                          F.lit(0.0), lambda a, p: a - p * F.log2(p))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.select(
        "*", F.length(url).alias("url_length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.size(F.filter(F.split("path", "/"), lambda p: p != "")).alias("depth"), share(url, "0-9").alias("digit_ratio"), share(F.col("host"), "0-9").alias("host_digit_ratio"),
        entropy.alias("host_entropy"), F.size(F.filter(F.split(query, "&"), lambda p: p != "")).alias("parameters"),
        F.length(F.regexp_replace("host", "[^-]", "")).alias("hyphens"), F.size(F.split("host", r"\.")).alias("labels"),
        F.array_max(F.transform(F.split("host", r"\."), lambda x: F.length(x))).alias("longest_label"), url.contains("#").cast("int").alias("has_fragment"),
        url.startswith("https:").cast("int").alias("secure"), *(_suffix(F.col("host"), n).alias(f"suffix{n}") for n in (1, 2, 3)))


def seed_labels(urls: DataFrame) -> DataFrame:
    """(url, block): 1 where a host label, split at hyphens, has a listed word; URLs without a host have no label."""
    host, _ = host_and_path(F.col("url"))
    parts = F.split(F.translate(host, "-", "."), r"\.")
    return urls.where(host != "").select("url", F.arrays_overlap(parts, F.array(*[F.lit(w) for w in BLOCKED_WORDS])).cast("int").alias("block"))


class Trees:
    def __init__(self, labelled: DataFrame, per_class: int = PER_CLASS) -> None:
        """Fit on (url, block)."""
        known = labelled.where(F.col("url").isNotNull() & F.col("block").isin(0, 1))
        picked = None
        for value in (0, 1):
            part = known.where(F.col("block") == value).orderBy(F.xxhash64("url"), "url").limit(per_class)
            picked = part if picked is None else picked.unionByName(part)
        host, path = host_and_path(F.col("url"))
        self._known = pin(features(picked.withColumn("host", host).withColumn("path", path)), "url-sample")      # 2 x per_class rows
        counts = {r["block"]: r["n"] for r in self._known.groupBy("block").agg(F.count("*").alias("n")).collect()}
        self.constant = None if len(counts) == 2 else next(iter(counts), 0)
        if self.constant is None:
            self.base = counts[1] / sum(counts.values())
            rows = self._with_rates(self._known, own=True)
            weighted = rows.withColumn("weight", F.when(F.col("block") == 1, 0.5 / counts[1]).otherwise(0.5 / counts[0]) * sum(counts.values()))
            self.model = GBTClassifier(featuresCol="x", labelCol="block", weightCol="weight", maxDepth=4, maxIter=20, stepSize=0.2, featureSubsetStrategy="0.5", seed=7).fit(self._assembled(weighted))

    def _with_rates(self, rows: DataFrame, own: bool = False) -> DataFrame:
        """Smoothed share of blocked URLs among the labelled ones with the same suffix.  ``own``: for a
        labelled URL among those of the other half only, so that no rate knows the row's own label, and
        unknown for every other host, so that the trees learn to do without it as well."""
        half = lambda flip: F.pmod(F.xxhash64("url") + flip, F.lit(2))
        if own:
            rows = rows.withColumn("_half", half(1))
        for n in (1, 2, 3):
            key = [f"suffix{n}", *(["_half"] if own else [])]
            known = self._known.withColumn("_half", half(0)) if own else self._known
            rates = known.groupBy(*key).agg(F.count("*").alias("_n"), F.sum("block").alias("_b"))
            rows = rows.join(F.broadcast(rates), key, "left")          # at most 2 x per_class suffixes
            rate = (F.coalesce("_b", F.lit(0)) + SMOOTH * self.base) / (F.coalesce("_n", F.lit(0)) + SMOOTH)
            if own:
                rate = F.when(F.pmod(F.xxhash64("host"), F.lit(2)) == 0, rate).otherwise(F.lit(self.base))
            rows = rows.withColumn(f"rate{n}", rate).drop("_n", "_b")
        return rows.drop("_half")

    @staticmethod
    def _assembled(rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows)

    def blocked(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, host, path and others) with ``blocked``."""
        if self.constant is not None:
            return rows.withColumn("blocked", F.lit(self.constant == 1))
        judged = self.model.transform(self._assembled(self._with_rates(features(rows))))
        return judged.select(*rows.columns, (F.col("prediction") == 1.0).alias("blocked"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    own = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    trees = Trees(seed_labels(own) if labelled is None else labelled)
    host, path = host_and_path(F.col("url"))
    rows = trees.blocked(own.withColumn("host", host).withColumn("path", path)).withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    return rows.select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                       F.coalesce(F.col("_r.verdict"), F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
