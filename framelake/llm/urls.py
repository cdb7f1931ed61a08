"""URL filter: allow and block rules, and gradient-boosted trees for URLs without a rule.

DataFrame operations only. Features are lexical (lengths, depth, digit ratio, entropy, parameter counts)
plus suffix statistics: the smoothed share of allowed URLs per host suffix among labelled ones. The trees are fitted
on about ``sample_rows`` labelled URLs (chosen by hash; a documented bound) and compiled into column expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import staged
from framelake.llm.trees import tree_column

SAMPLE_ROWS = 20_000
TREES, DEPTH = 12, 3
MAX_RULES = 1_000
BROADCAST_SUFFIXES = 100_000
FEATURES = ["url_len", "host_len", "path_len", "depth", "labels", "digit_share", "host_digits", "hyphens", "entropy", "params", "query_len",
            "has_fragment", "has_extension", "tld_share", "suffix_share"]


def url_parts(pages: DataFrame, *more: str) -> DataFrame:
    """``page_id, url, host, path`` and the columns named in ``more``; both parts are empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"), path.alias("path"), *more)


def rule_columns(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null if none fits), for ``(verdict, "host/path")`` rules.

    A rule fits its host and all its subdomains if the path starts with the rule's. Of equally long
    rules the first wins. At most ``MAX_RULES`` rules (they become one expression).
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        host, _, path = rule.partition("/")
        path = f"/{path}" if "/" in rule else ""
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def _entropy(text: Column) -> Column:
    n = F.length(text).cast("double")
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(
        c != "", (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n).otherwise(F.lit(0.0)))
    return F.when(n > 0, F.aggregate(share, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))).otherwise(F.lit(0.0))


def lexical_features(parts: DataFrame) -> DataFrame:
    """``parts`` with the lexical features and the host's last label and last two labels."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    host, path = F.col("host"), F.col("path")
    digits = "0123456789"
    cols = {
        "url_len": F.length(url), "host_len": F.length(host), "path_len": F.length(path), "depth": _count(path, "/"),
        "labels": _count(host, ".") + 1, "digit_share": _count(url, digits) / F.greatest(F.length(url), F.lit(1)), "host_digits": _count(host, digits),
        "hyphens": _count(host, "-"), "entropy": _entropy(url), "params": F.when(query != "", _count(query, "&") + 1).otherwise(F.lit(0.0)),
        "query_len": F.length(query), "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "has_extension": F.regexp_like(path, F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("int")}
    return parts.select("*", *(c.cast("double").alias(n) for n, c in cols.items()), F.substring_index("host", ".", -1).alias("tld"),
                        F.substring_index("host", ".", -2).alias("suffix"))


def _with_shares(rows: DataFrame, stats: dict[str, DataFrame], prior: float) -> DataFrame:
    for key, table in stats.items():
        rows = rows.join(table, key, "left").withColumn(f"{key}_share", F.coalesce(f"{key}_share", F.lit(prior)))
    return rows


def classify_urls(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS,
                  trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score``.

    The verdict is the longest fitting rule's, else ``allow`` if the trees' ``score`` is 0.5 or more, else ``block``. The trees learn
    from ``labelled`` (``url``, ``label`` 1 for allowed), by default the URLs of ``pages`` that a rule decides. Without labelled URLs of
    both kinds the score is the share of allowed ones (1 if there are none). Null urls have empty parts and are scored too.
    Repeated rows are each judged; other columns are ignored.
    """
    name, verdict = rule_columns(rules)
    rows = lexical_features(url_parts(pages)).withColumn("rule", name).withColumn("decided", verdict)
    if labelled is None:
        known = rows.where("decided is not null").withColumn("label", (F.col("decided") == "allow").cast("double"))
    else:
        known = lexical_features(url_parts(labelled.select(F.lit(0).alias("page_id"), "url", F.col("label").cast("double")), "label"))
        known = known.where("label is not null")
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n == 0 or ones in (0.0, float(n)):
        score = F.lit(1.0 if n == 0 else ones / n)
    else:
        prior = ones / n
        stats = {}
        for key in ("tld", "suffix"):
            share = staged(known.groupBy(key).agg(((F.sum("label") + 10 * prior) / (F.count("*") + 10)).alias(f"{key}_share")), key)
            stats[key] = F.broadcast(share) if share.count() <= BROADCAST_SUFFIXES else share
        some = known if n <= sample_rows else known.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / n))
        sample = staged(_with_shares(some, stats, prior).select("label", *FEATURES).repartition(2), "urls")
        model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=5).fit(
            VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))
        margin = reduce(lambda a, b: a + b, [F.lit(float(w)) * tree_column(t, FEATURES) for w, t in zip(model.treeWeights, model.trees)])
        rows = _with_shares(rows, stats, prior)
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * margin))
    return rows.withColumn("score", score).select(
        "page_id", "host", "path", "rule", F.coalesce("decided", F.when(F.col("score") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"),
        "score")
