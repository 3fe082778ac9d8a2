"""URL filter: allow and block rules, and for other URLs a logistic regression
on hashed character n-grams of host and path.

All of it is DataFrame expressions.  The model is trained by full-batch gradient
steps: each step scores the labelled URLs, adds up the gradient per feature in
one aggregation and brings the ``2 ** BITS`` weights back; the labelled table is
bounded, and so is the model, which later expressions hold as a constant array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, stored

BITS = 12
GRAMS = (3, 4)             # characters per n-gram
MAX_LABELS = 2_000         # labelled URLs that the model is trained on, at most
STEPS, RATE, L2 = 15, 4.0, 1e-3

Rule = tuple[str, str]     # (verdict, "host/path")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for a null URL or one without ://."""
    u = F.coalesce(F.col(url), F.lit(""))
    start = F.locate("://", u)
    rest = F.when(start > 0, F.expr(f"substring(coalesce({url}, ''), instr(coalesce({url}, ''), '://') + 3)")
                  ).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumn("host", ascii_lower(host)).withColumn("path", path)


def rule_of(rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits host and path, else null.
    A rule fits its host and all subdomains of it, and paths that start with its own."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):     # a longer rule overrides
        host, slash, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(slash + path))
        found = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def features() -> Column:
    """Distinct hashed n-grams of host and path, each marked with its part and with ends."""
    return F.array_distinct(F.concat(*[_grams(tag, n) for tag in ("host", "path") for n in GRAMS]))


def _grams(tag: str, n: int) -> Column:
    text = F.concat(F.lit("^"), F.col(tag), F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.pmod(
        F.xxhash64(F.lit(tag), text.substr(i, F.lit(n))), F.lit(1 << BITS)).cast("int"))


def constant(weights: list[float]) -> Column:
    """The weights as one array constant (folded by the optimizer)."""
    return F.split(F.lit(",".join(repr(float(w)) for w in weights)), ",").cast("array<double>")


def logit(at: Column, weights: list[float], bias: float) -> Column:
    table = constant(weights)
    total = F.aggregate(at, F.lit(0.0), lambda s, i: s + F.get(table, i))
    return total / F.sqrt(F.greatest(F.size(at), F.lit(1)).cast("double")) + F.lit(float(bias))


def sigmoid(v: Column) -> Column:
    return 1 / (1 + F.exp(-v))


def train(labelled: DataFrame, limit: int = MAX_LABELS, steps: int = STEPS) -> tuple[list[float], float]:
    """Weights and intercept from (url, label) rows, label 1 for allow.

    Of more than ``limit`` distinct URLs those with the smallest hash are used.  An
    empty table gives zero weights, so every URL scores one half."""
    rows = (labelled.filter("url is not null and label is not null").groupBy("url")
            .agg(F.max("label").alias("label")).orderBy(F.xxhash64("url"), "url").limit(limit))
    rows = stored(with_parts(rows).select("label", features().alias("at")), "url-training").coalesce(1)
    n = rows.count()
    weights, bias = [0.0] * (1 << BITS), 0.0
    squares, bias_square = [1e-6] * (1 << BITS), 1e-6
    for _ in range(steps if n else 0):
        scale = F.sqrt(F.greatest(F.size("at"), F.lit(1)).cast("double"))
        error = rows.select((sigmoid(logit(F.col("at"), weights, bias)) - F.col("label")).alias("e"),
                            scale.alias("scale"), "at")
        sums = (error.select((F.col("e") / F.col("scale")).alias("g"), F.explode(
            F.concat("at", F.array(F.lit(-1)))).alias("i"), "e")
            .groupBy("i").agg(F.sum(F.when(F.col("i") == -1, F.col("e")).otherwise(F.col("g"))).alias("g"))
            .collect())                       # at most 2 ** BITS + 1 rows
        for r in sorted(sums):
            g = r.g / n
            if r.i < 0:
                bias_square += g * g
                bias -= 0.5 * g / bias_square ** 0.5
                continue
            g += L2 * weights[r.i]
            squares[r.i] += g * g
            weights[r.i] -= RATE * 0.1 * g / squares[r.i] ** 0.5
    return weights, bias


def labelled_by_rules(pages: DataFrame, rules: list[Rule], limit: int = MAX_LABELS) -> DataFrame:
    """A small labelled table from the URLs that the rules decide: half of
    ``limit`` for either verdict, those with the smallest hash."""
    known = (with_parts(pages.select("url")).withColumn("r", rule_of(rules)).filter("r is not null")
             .select("url", (F.col("r.verdict") == "allow").cast("int").alias("label")).distinct())
    known = stored(known, "url-known")
    half = lambda label: (known.filter(F.col("label") == label)
                          .orderBy(F.xxhash64("url"), "url").limit(limit // 2))
    return half(1).unionByName(half(0))


def judge(pages: DataFrame, rules: list[Rule], model: tuple[list[float], float], *keep: str,
          url: str = "url") -> DataFrame:
    """Columns ``keep``, host, path, rule, score and verdict for every row.

    The rule's verdict where one fits, else allow from a score of one half.  A
    null URL has empty parts and gets the model's verdict on them."""
    rows = with_parts(pages.select(*[F.col(k) for k in keep], F.col(url).alias("__url")), "__url")
    scored = (rows.withColumn("__rule", rule_of(rules)).withColumn("__at", features())
              .withColumn("score", sigmoid(logit(F.col("__at"), *model))))
    own = F.when(F.col("score") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select(*keep, "host", "path", F.col("__rule.rule").alias("rule"), "score",
                         F.coalesce(F.col("__rule.verdict"), own).alias("verdict"))
