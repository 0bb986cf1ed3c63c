"""Personal data by bootstrapped contextual extraction.

Entities of four kinds that a pattern and a check can tell (e-mail, IPv4, card, phone) are the seeds. The words right before
them become lexical patterns. Patterns and the strings they precede form a weighted graph; in each round a pattern
gets, per kind, the mean confidence of its strings, and a string the mean of its patterns, seeds staying at 1. Patterns
that end up sure of a kind and that `SUPPORT` different strings back, seeds or strings that are sure by then, mark other
identifiers, words with three digits or an @, that stand after them and that no base rule matched.

DataFrame code only: texts are read once, what comes out of them is narrow and linear in the number of matches. Base
patterns are written so that no text makes them backtrack: a run of letters is entered at its start only.

Defined results: NULL text is empty; per kind, matches are leftmost and do not overlap; those that fail their check are
dropped without another try; offsets count code points; an added span takes the kind its pattern is surest of; repeated
rows are documents of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.llm.common import read_table, stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SURE = 0.8
SUPPORT = 5
#: Letters before an entity in which its context word is looked for.
CONTEXT = 64

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a word with a digit or an @
    "word": r"(?:\G|(?<!\S))[^\s0-9@]*+[0-9@]\S*+",
}
#: Texts without these hold nothing of the kind.
SCREENS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]", "word": "[0-9@]"}
EDGES = r"[^\p{L}\p{N}@+]"


def _hits(kind: str) -> Column:
    """Of each match in a text: letters since the match before, the end of what stands there, and the match."""
    pattern = F.lit(PATTERNS[kind])
    zipped = F.arrays_zip(F.regexp_extract_all("text", pattern, F.lit(0)).alias("m"), F.split("text", PATTERNS[kind], -1).alias("g"))
    told = F.transform(
        zipped, lambda x: F.struct(F.length(x["m"]).alias("size"), F.length(x["g"]).alias("gap"), F.right(x["g"], F.lit(CONTEXT)).alias("tail"), x["m"].alias("m"))
    )
    return F.when(F.col("text").rlike(SCREENS[kind]), told)


def found(docs: DataFrame) -> DataFrame:
    """A stored row per document: `row`, `doc_id` and the matches by kind."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), _hits(k).alias("hits")) for k in PATTERNS])
    return stored(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", kinds.alias("kinds")), "matches")


def placed(table: DataFrame) -> DataFrame:
    """A row per match with `start` and `stop` in its text. A window holds the matches of one kind in one text."""
    each = table.select("row", F.explode("kinds").alias("k")).select("row", "k.kind", F.posexplode("k.hits").alias("i", "h"))
    each = each.select("row", "kind", "i", "h.*").where("m IS NOT NULL")
    stop = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "kind").orderBy("i"))
    return each.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size"))


def luhn(digits: str) -> Column:
    """Whether the digits pass the check of card numbers."""
    return F.expr(
        f"aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum + CASE WHEN i % 2 = 0 THEN "
        f"2 * int(substr(reverse({digits}), i, 1)) - IF(int(substr(reverse({digits}), i, 1)) > 4, 9, 0) "
        f"ELSE int(substr(reverse({digits}), i, 1)) END) % 10 = 0"
    )


def passes() -> Column:
    """The check of each kind, on columns `kind`, `m` and `digits`."""
    byte = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    n = F.length("digits")
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.col("m").rlike(rf"^{byte}(?:\.{byte}){{3}}$"))
        .when(F.col("kind") == "card", F.when(n.between(12, 19), luhn("digits")).otherwise(False))
        .when(F.col("kind") == "phone", n.between(9, 15))
        .otherwise(False)
    )


def base_spans(spots: DataFrame) -> DataFrame:
    return spots.where("kind <> 'word'").withColumn("digits", F.regexp_replace("m", "[^0-9]", "")).where(passes()).drop("digits")


def context(tail: str) -> Column:
    """The last word before an entity, in lower case; NULL where there is none."""
    word = F.lower(F.regexp_extract(tail, r"(\S{1,40})\s*$", 1))
    return F.when(word != "", word)


def free_words(spots: DataFrame, base: DataFrame) -> DataFrame:
    """Identifiers, trimmed of marks, that overlap no base span: `row`, `start`, `stop`, `instance`, `pattern`."""
    lead = F.length("m") - F.length(F.regexp_replace("m", f"^{EDGES}++", ""))
    core = F.regexp_replace(F.regexp_replace("m", f"^{EDGES}++", ""), r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
    words = spots.where("kind = 'word'").select("row", (F.col("start") + lead).alias("start"), core.alias("m"), "tail")
    words = words.withColumn("stop", F.col("start") + F.length("m")).where("length(regexp_replace(m, '[^0-9]', '')) >= 3 OR contains(m, '@')")
    both = words.select("row", "start", "stop", "m", "tail", F.lit(False).alias("known")).unionByName(
        base.select("row", "start", "stop", "m", "tail", F.lit(True).alias("known"))
    )
    order = Window.partitionBy("row").orderBy("start", F.desc("known"))
    reach = F.max(F.when(F.col("known"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # what comes next, by a running minimum from the end: a frame that ends at the end would be gone through for every row
    back = Window.partitionBy("row").orderBy(F.desc("start"), "known").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = F.min(F.when(F.col("known"), F.col("start"))).over(back)
    apart = both.withColumns({"_reach": reach, "_next": onward}).where("NOT known")
    apart = apart.where("coalesce(_reach, 0) <= start AND coalesce(_next, stop) >= stop")
    return apart.select("row", "start", "stop", F.lower("m").alias("instance"), context("tail").alias("pattern"))


def confident(seeds: DataFrame, words: DataFrame, rounds: int = ROUNDS, sure: float = SURE, support: int = SUPPORT) -> DataFrame:
    """`pattern`, `kind` and `score` of the patterns that are sure of a kind. `seeds`: instance, kind, pattern of base
    spans; `words`: instance and pattern of other identifiers."""
    seeds, words = seeds.where("pattern IS NOT NULL"), words.where("pattern IS NOT NULL")
    edges = seeds.select("pattern", "instance").unionByName(words.select("pattern", "instance"))
    edges = stored(edges.groupBy("pattern", "instance").agg(F.count("*").alias("w")), "edges")
    known = stored(seeds.select("instance", "kind").distinct(), "seeds")
    of_pattern, of_instance = (edges.groupBy(c).agg(F.sum("w").alias("all")) for c in ("pattern", "instance"))
    strings = known.withColumn("r", F.lit(1.0))
    unseen = edges.join(known.select("instance").distinct(), "instance", "left_anti")
    patterns = None
    for i in range(rounds):
        # an instance backs a pattern once it is sure itself, seed or learned; edges hold each pair once
        backing = F.count_if(F.col("r") >= sure).alias("backing")
        heard = edges.join(strings, "instance").groupBy("pattern", "kind").agg(F.sum(F.col("w") * F.col("r")).alias("sum"), backing)
        scored = heard.join(of_pattern, "pattern").select("pattern", "kind", (F.col("sum") / F.col("all")).alias("r"), "backing")
        patterns = stored(scored, "patterns")
        if i < rounds - 1:
            heard = unseen.join(patterns, "pattern").groupBy("instance", "kind").agg(F.sum(F.col("w") * F.col("r")).alias("sum"))
            learned = heard.join(of_instance, "instance").select("instance", "kind", (F.col("sum") / F.col("all")).alias("r"))
            strings = stored(known.withColumn("r", F.lit(1.0)).unionByName(learned), "strings")
    chosen = patterns.where((F.col("r") >= sure) & (F.col("backing") >= support))
    return chosen.groupBy("pattern").agg(F.max_by("kind", F.struct("r", "kind")).alias("kind"), F.max("r").alias("score"))


def extract(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with their `row`, and all spans: `row`, `kind`, `start`, `stop` and whether one is `base`."""
    table = found(docs)
    spots = stored(placed(table), "spots")
    base = base_spans(spots)
    seeds = base.select(F.lower("m").alias("instance"), "kind", context("tail").alias("pattern"))
    words = stored(free_words(spots, base), "words")
    added = words.join(confident(seeds, words), "pattern").select("row", "kind", "start", "stop", F.lit(False).alias("base"))
    return table.select("row", "doc_id"), base.select("row", "kind", "start", "stop", F.lit(True).alias("base")).unionByName(added)


def op5_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    rows, spans = extract(read_table(spark, folder, "documents"))
    rank = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS.index(k)), KINDS, F.when(F.lit(False), -1))
    text = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    spot = F.struct("start", rank.alias("rank"), "stop", text.alias("text"))
    listed = lambda c: F.concat_ws(",", F.transform(F.array_sort(c), lambda s: s["text"]))
    per_row = spans.groupBy("row").agg(
        *[F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS],
        listed(F.collect_list(F.when(F.col("base"), spot))).alias("_base"),
        listed(F.collect_list(spot)).alias("spans"),
    )
    out = rows.join(per_row, "row", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("_base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
