"""F1-F3, F8 with the rules as a table: any number of (rule_no, field, pattern) rows, one pass.

A rule hits a text of its field that contains its pattern. Every pattern has an anchor, the rarest
of its character n-grams in the texts; a text's n-grams that are no rule's anchor end in the stage
that reads the text, the others are joined to the rules, and ``contains`` decides. Equal texts of a
field are searched once, and so are equal patterns; ids and rule numbers come back behind. A pattern
shorter than GRAM is its own n-gram, the empty one hits every text. Nothing is collected, and
neither the rules nor the texts are limited in number or length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .clean import ANSWER, QUESTION, TITLE
from .sketches import bucket_filter, rarest

GRAM = 5


def _grams(text: str, n: Column) -> Column:
    """The distinct n-grams of a text, or [""] for n = 0."""
    at = F.sequence(F.lit(1), F.length(text) - n + 1)
    grams = F.array_distinct(F.transform(at, lambda i: F.substring(F.col(text), i, n)))
    return F.when(n == 0, F.array(F.lit(""))).when(F.length(text) >= n, grams)


def _hash(field: str, gram: str) -> Column:
    return F.xxhash64(F.col(field), F.col(gram))


def _text_hits(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """texts (field, text), rules (field, pattern) -> field, text, pattern: every distinct text of a
    field with the distinct patterns of that field which it contains."""
    rules = rules.where("field IS NOT NULL AND pattern IS NOT NULL").select("field", "pattern").distinct()
    texts = texts.where("text IS NOT NULL").select("field", "text").distinct()
    key = lambda text: F.sha2(F.concat_ws("\u001f", "field", text), 256)
    n = F.least(F.length("pattern"), F.lit(GRAM))
    patterns = rules.withColumn("__key", key("pattern"))
    choices = patterns.select("__key", "field", F.explode(_grams("pattern", n)).alias("g")).select(
        "__key", _hash("field", "g").alias("h"))
    # lengths in use, per field: long patterns only, as a rule, so that a text gives n-grams of
    # one length, and none if no rule has its field
    lengths = rules.groupBy("field").agg(F.sort_array(F.collect_set(n)).alias("lengths"))
    read = texts.join(F.broadcast(lengths), "field").select(
        "field", "text", key("text").alias("id"), F.explode("lengths").alias("n"))
    grams = read.select("id", "field", F.explode(_grams("text", F.col("n"))).alias("g")).select(
        "id", _hash("field", "g").alias("h"))
    anchor = rarest(choices, grams, "__key")
    pairs = bucket_filter(grams, anchor).join(anchor, "h").select("id", "__key").distinct()
    return (pairs.join(patterns.select("__key", "pattern"), "__key")
            .join(texts.withColumn("id", key("text")), "id")
            .where(F.contains("text", "pattern")).select("field", "text", "pattern"))


def _met(hits: DataFrame, texts: DataFrame, rules: DataFrame) -> DataFrame:
    """id, rule_no of the texts and rules that hits names."""
    return (hits.join(rules, ["field", "pattern"]).join(texts.where("id IS NOT NULL"), ["field", "text"])
            .select("id", "rule_no").distinct())


def pattern_hits(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """texts (id, field, text), rules (rule_no, field, pattern) -> id, rule_no: a row for every
    rule that hits one of an id's texts. Null ids, fields, texts and patterns hit nothing; repeated
    rules and texts give one row per id and rule_no."""
    return _met(_text_hits(texts, rules), texts, rules)


def item_texts(items: DataFrame) -> DataFrame:
    """items -> id (ord), field, text: the title, the answer and the question."""
    fields = F.array(*[F.struct(F.lit(f).alias("field"), c.alias("text"))
                       for f, c in (("title", TITLE()), ("answer", ANSWER()), ("question", QUESTION()))])
    return items.select(F.col("ord").alias("id"), F.inline(fields))


def exclude_by_table(items: DataFrame, rules: DataFrame) -> DataFrame:
    """F1-F3 for a table of rules: the items that no rule hits."""
    texts = item_texts(items)
    hit = texts.join(_text_hits(texts, rules).select("field", "text").distinct(), ["field", "text"],
                     "left_semi").select(F.col("id").alias("ord")).distinct()
    return items.join(hit, "ord", "left_anti")


def rule_table_counts(items: DataFrame, rules: DataFrame) -> DataFrame:
    """F4 for a table of rules: rule_no, hits (items that the rule hits, 0 included).

    Ids are counted per distinct text and these counts added per pattern, so rules with one pattern
    do not meet the items one by one. Only ids with several texts in a field, and rule numbers with
    several patterns, do."""
    texts = item_texts(items).where("id IS NOT NULL AND text IS NOT NULL")
    hits = cut_lineage(_text_hits(texts, rules))
    own = texts.groupBy("id", "field").agg(F.min("text").alias("text"), F.max("text").alias("__last"))
    sizes = own.where(F.col("text") == F.col("__last")).groupBy("field", "text").agg(
        F.count(F.lit(1)).alias("n"))
    several = texts.join(own.where(F.col("text") != F.col("__last")).select("id", "field"),
                         ["id", "field"], "left_semi")
    counted = hits.join(sizes, ["field", "text"]).select("field", "pattern", "n").unionByName(
        hits.join(several, ["field", "text"]).select("field", "pattern", "id").distinct().select(
            "field", "pattern", F.lit(1).cast("long").alias("n")))
    per_pattern = counted.groupBy("field", "pattern").agg(F.sum("n").alias("hits"))
    each = rules.where("field IS NOT NULL AND pattern IS NOT NULL").groupBy("rule_no").agg(
        F.min(F.struct("field", "pattern")).alias("a"), F.max(F.struct("field", "pattern")).alias("z"))
    one = each.where(F.col("a") == F.col("z")).select("rule_no", "a.field", "a.pattern")
    many = rules.join(each.where(F.col("a") != F.col("z")).select("rule_no"), "rule_no", "left_semi")
    found = one.join(per_pattern, ["field", "pattern"]).select("rule_no", "hits").unionByName(
        _met(hits, texts, many).groupBy("rule_no").agg(F.count(F.lit(1)).alias("hits")))
    return rules.select("rule_no").distinct().join(found, "rule_no", "left").select(
        "rule_no", F.coalesce("hits", F.lit(0)).alias("hits"))
