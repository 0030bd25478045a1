"""URL filter: rule lists first, else logistic regression on hashed character n-grams.

Host and path are cut out by one regular expression; a rule such as ``example.net/en/``
fits its host and every subdomain when the path starts with the rule's path, and the
longest fitting rule wins. Urls without a rule are judged by a binary logistic regression
over hashed character 3- to 5-grams of host and path (presence features), fitted on a small
labelled URL table. The fit sees only that table, whose size is checked
(``max_labelled``); scoring is a projection over the pages: no shuffle, no Python.

Defined results: null url or no ``://``: host and path empty, only the n-grams of the end marks, so the verdict
is near the model's prior. Very long urls are judged whole. Of rules that fit, the longest wins, and of equally long ones the
first in code-point order (rules of one length that fit the same url differ in host and path, never in both alike).
Repeated rows are judged alike, an empty table gives an empty result. Other columns of the input are
ignored (only the named id and url columns are read), whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: (verdict, rule) of the production list -- fixed values.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))

GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
BLOCK_AT = 0.8  # no held-out harmless word of the labelled table reaches it

# Words of the built-in labelled table, by subject. Every template and affix is used alike for both classes, so that
# only the words carry the label.
BLOCK_WORDS = {
    "gambling": ("casino", "poker", "roulette", "blackjack", "sportsbook", "betting", "bookmaker", "jackpot", "lottery", "wager",
                 "gambling", "baccarat", "slotmachine", "bingo"),
    "adult": ("porn", "xxx", "adult", "escort", "erotic", "nude", "camgirls", "hookup", "fetish", "sexchat"),
    "piracy": ("warez", "torrent", "keygen", "cracked", "nulled", "serialkeys", "piratebay", "freemovies"),
    "pills": ("viagra", "cialis", "pills", "pharmacy-cheap", "steroids", "tramadol", "weightloss"),
    "money": ("payday-loan", "quickcash", "forex-signals", "bitcoin-doubler", "getrich", "prizewinner", "giveaway", "sweepstakes"),
    "advertising": ("adserver", "advert", "advertising", "banners", "popunder", "clicktracker", "tracking", "affiliates", "clickbait",
                    "promo", "sponsored-links"),
    "abuse": ("spam", "spammer", "link-exchange", "malware", "phishing", "botnet", "replica-watches", "counterfeit", "fake-ids"),
}
ALLOW_WORDS = {
    "public": ("news", "library", "museum", "university", "school", "council", "parliament", "embassy", "hospital", "railway", "harbour"),
    "learning": ("history", "science", "physics", "chemistry", "astronomy", "geology", "grammar", "teaching", "nursing", "lectures",
                 "encyclopedia", "journal", "thesis"),
    "home": ("recipes", "cooking", "garden", "kitchen", "knitting", "furniture", "health", "parenting", "camping", "fishing"),
    "arts": ("music", "theatre", "painting", "writing", "poetry", "novels", "cinema", "photography", "orchestra", "ballet", "archive"),
    "work": ("docs", "software", "manual", "forum", "market", "factory", "farming", "logistics", "banking", "insurance", "carpentry"),
    "places": ("weather", "travel", "mountain", "river", "island", "village", "hotel", "castle", "airport", "valley", "coast"),
    "sport": ("football", "cycling", "rowing", "tennis", "running", "chess", "skating", "athletics"),
}
AFFIXES = ("{w}", "{w}-online", "my{w}", "best-{w}", "{w}24", "{w}-hub", "the-{w}", "{w}world")
TEMPLATES = ("https://www.{x}.example.org/en/{n}/", "http://{x}.example.com/es/{n}", "https://m.{x}.example.net/fr/{n}.html",
             "https://blog.example.org/{x}/{n}", "http://{x}{n}.example.com/", "https://example.net/de/{n}/{x}.php?page=2",
             "https://{x}.test/index/{n}", "http://shop.test/{x}-{n}.html", "https://user{n}.pages.test/{x}")


def labelled_urls(spark: SparkSession, without: tuple[str, ...] = ()) -> DataFrame:
    """The built-in labelled table (url, label): label 1 = block. Every word with every affix, in templates that take
    turns; ``without`` leaves words out (for held-out tests)."""
    rows = []
    for label, words in ((1, BLOCK_WORDS), (0, ALLOW_WORDS)):
        for i, w in enumerate(w for group in words.values() for w in group if w not in without):
            for j, affix in enumerate(AFFIXES):
                rows += [(TEMPLATES[(i + j + k) % len(TEMPLATES)].format(x=affix.format(w=w), n=100 + 37 * i + j), label) for k in (0, 4)]
    values = ", ".join(f"('{u}', {y}D)" for u, y in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; both null without one."""
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        h, p = r.split("/", 1)
        fits = (((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p)))
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def url_grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each with its own prefix and end marks."""
    def grams(text: Column, mark: str, n: int) -> Column:
        return F.when(F.length(text) >= n, F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))),
            lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
        ).otherwise(F.array().cast("array<string>"))
    marked = [(F.concat(F.lit("^"), host, F.lit("$")), "h:"), (F.concat(path, F.lit("$")), "p:")]
    return F.flatten(F.array(*[grams(t, m, n) for t, m in marked for n in GRAMS]))


def _features(df: DataFrame) -> DataFrame:
    tf = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=BUCKETS, binary=True)
    return tf.transform(df.withColumn("_grams", url_grams(F.col("host"), F.col("path"))))


def fit_url_model(labelled: DataFrame, max_labelled: int = 100_000,
                  reg: float = 1e-3) -> LogisticRegressionModel:
    """Fit on (url, label); the table is small by contract, which is checked, not assumed."""
    n = labelled.count()
    if n > max_labelled:
        raise ValueError(f"labelled URL table has {n} rows; the fit takes {max_labelled} at most")
    rows = _features(labelled.select(host_of(F.col("url")).alias("host"),
                                     path_of(F.col("url")).alias("path"),
                                     F.col("label").cast("double").alias("label")))
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=reg,
                              standardization=False, maxIter=100).fit(rows.coalesce(1))


def filter_urls(pages: DataFrame, model: LogisticRegressionModel, rules=RULES,
                id_col: str = "page_id", url_col: str = "url",
                block_at: float = BLOCK_AT) -> DataFrame:
    """(id, host, path, rule, verdict, block_probability) for every row of ``pages``."""
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    model.setProbabilityCol("_p").setRawPredictionCol("_raw").setPredictionCol("_y")
    scored = model.transform(_features(urls))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    p = vector_to_array(F.col("_p"))[1]
    return scored.select(id_col, "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(p >= block_at, "block").otherwise("allow")).alias("verdict"),
                         p.alias("block_probability"))
