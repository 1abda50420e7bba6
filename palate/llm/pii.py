"""Personal data: spans of protected entities, and the terms of their texts that corpus statistics show to reveal them.

Columns and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palate.llm.common import sized_broadcast, written
from palate.llm.patterns import no_spans, replaced, spans_of

# Kinds in their listed order (fixed values); a pattern starts only where a match can start, so runs are read once.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# Terms: words of four letters or more; those anywhere in a text that holds an entity may reveal it.
TERM = r"\p{L}[\p{L}\p{N}]{3,}+"
# A term goes if its mutual information with an entity is at least this share of the entity's own information,
DISCLOSURE = 0.8
# estimated from at least so many different texts.
SUPPORT = 2
# copies of a text that meet its terms under one key, and the most keys that a text gets
COPIES = 1_000
MOST_PARTS = 4_096


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digit string passes the Luhn check."""
    def value(place):
        digit = F.substring(number, F.length(number) - place + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(place % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(number)), value), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def is_card(found: Column) -> Column:
    number = digits(found)
    return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(F.lit(False))


def base_spans(text: Column) -> Column:
    """Entities by kind, then start: array of (start, order, kind, end, found)."""
    has_digit = text.rlike("[0-9]")
    return F.concat(
        F.when(F.contains(text, F.lit("@")), spans_of(text, "email", 0, EMAIL)).otherwise(no_spans()),
        F.when(has_digit, spans_of(text, "ip", 1, IP, lambda m: m.rlike(OCTETS))).otherwise(no_spans()),
        F.when(has_digit, spans_of(text, "card", 2, CARD, is_card)).otherwise(no_spans()),
        F.when(F.contains(text, F.lit("+")), spans_of(
            text, "phone", 3, PHONE, lambda m: F.length(digits(m)).between(9, 15))).otherwise(no_spans()))


def entity(span: Column) -> Column:
    """What makes two spans the same entity: the address in lower case, or the digits."""
    value = F.when(span["kind"] == "email", F.lower(span["found"])).when(span["kind"] == "ip", span["found"]).otherwise(digits(span["found"]))
    return F.concat(span["kind"], F.lit(":"), value)


def blanked(text: Column, spans: Column) -> Column:
    """The text with spaces for the characters of entities, so that places stay."""
    def step(state, span):
        start = F.greatest(span["start"], state["at"])
        gap, blank = F.substring(text, state["at"] + 1, start - state["at"]), F.repeat(F.lit(" "), span["end"] - start)
        moved = F.struct(span["end"].alias("at"), F.concat(state["out"], gap, blank).alias("out"))
        return F.when(span["end"] > state["at"], moved).otherwise(state)

    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))


def words_of(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def places_of(units: DataFrame) -> DataFrame:
    """(_row, term, start, end) of every term of a text, places as running sums of lengths."""
    between, found = F.split("_blank", TERM, -1), F.regexp_extract_all("_blank", F.lit(TERM), F.lit(0))
    parts = F.transform(F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("found")), lambda p: F.struct(
        F.length(p["gap"]).alias("gap"), F.length(p["found"]).alias("long"), F.lower(p["found"]).alias("term")))
    end = F.sum(F.col("p.gap") + F.col("p.long")).over(Window.partitionBy("_row").orderBy("at")).cast("int")
    return (
        units.select("_row", F.posexplode(parts).alias("at", "p")).withColumn("end", end)
        .select("_row", "p.term", (F.col("end") - F.col("p.long")).alias("start"), "end")
    )


def revealing_terms(units: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(_row, term): the terms of each text that disclose an entity of the text.

    A pair discloses if its mutual information reaches DISCLOSURE of the entity's information: share = ln(n_te * n /
    (n_t * n_e)) / ln(n / n_e), with n documents, n_e with the entity, n_t with the term and n_te with the entity and,
    outside entities, the term. Counts cover all documents and whole texts. As n_te is n_e at most, only terms with
    n_t <= n * (n_e / n) ** DISCLOSURE can disclose; pairs are made of those alone.
    """
    total = float(docs.count())
    holders = units.select("_row", "copies", F.explode(F.array_distinct(F.transform("spans", entity))).alias("entity"))
    entities = written(
        holders.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count(F.lit(1)).alias("texts"))
        .where((F.col("texts") >= SUPPORT) & (F.col("n_e") < total))
        .select("entity", "n_e", (F.pow(F.col("n_e") / total, F.lit(DISCLOSURE)) * total * (1 + 1e-9)).alias("most")), "shared")
    holders = written(holders.join(sized_broadcast(entities), "entity"), "holders")
    widest = holders.groupBy("_row").agg(F.max("most").alias("widest"))
    held = units.select("_row", "_blank").join(sized_broadcast(widest), "_row").select(
        "_row", "widest", F.explode(words_of(F.col("_blank"))).alias("term"))
    wanted = written(held.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= SUPPORT).select("term"), "terms")
    terms = written(
        docs.select(F.explode(words_of(F.col(text))).alias("term")).join(sized_broadcast(wanted), "term", "left_semi")
        .groupBy("term").agg(F.count(F.lit(1)).alias("n_t")), "counts")
    rare = held.join(sized_broadcast(terms), "term").where("n_t <= widest").select("_row", "term", "n_t")
    met = written(rare.join(holders, "_row").where("n_t <= most").select("_row", "entity", "term", "copies", "n_t", "n_e"), "met")
    own, shared = F.log(total / F.col("n_e")), F.log(F.col("n_te") * total / (F.col("n_t") * F.col("n_e")))
    bad = written(
        met.groupBy("entity", "term", "n_t", "n_e").agg(F.sum("copies").alias("n_te"), F.count(F.lit(1)).alias("texts"))
        .where((F.col("texts") >= SUPPORT) & (shared / own >= DISCLOSURE)).select("entity", "term"), "pairs")
    return met.join(sized_broadcast(bad), ["entity", "term"], "left_semi").select("_row", "term").distinct()


def find_personal_data(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """`columns` of every row plus `spans`, array of (start, order, kind, end, found), by kind, then start.

    Kinds are the entities' and 'term' for words that reveal an entity of the same text (see `revealing_terms`), at every
    place of the text. Places are code points, end exclusive. Null texts count as empty and have no spans; copies of a text
    share their spans and count as one text in the support of a term; repeated rows stay; an empty table gives no rows. A kept
    column named `spans` gives way to the result, other names cannot clash. A very long text is searched as a whole.
    """
    kept = [docs[c].alias(c) for c in columns if c != "spans"]
    kept = [F.struct(*kept).alias("_kept")] if kept else []
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(*kept, body.alias("_text")).withColumn("spans", base_spans(F.col("_text")))
    rows = written(rows.select(
        *(["_kept"] if kept else []), "spans", F.pmod(F.monotonically_increasing_id(), F.lit(MOST_PARTS)).alias("_place"),
        # rows without entities get keys too, so that the last join deals them out evenly
        F.when(F.size("spans") > 0, F.sha2("_text", 256)).otherwise(F.xxhash64("_text").cast("string")).alias("_row"),
        F.when(F.size("spans") > 0, blanked(F.col("_text"), F.col("spans"))).alias("_blank")), "entities")
    units = written(rows.where("size(spans) > 0").groupBy("_row").agg(
        F.count(F.lit(1)).alias("copies"), F.first("spans").alias("spans"), F.first("_blank").alias("_blank")), "units")
    marked = written(revealing_terms(units, docs, text), "marked")
    texts = units.join(sized_broadcast(marked.select("_row").distinct()), "_row", "left_semi")
    hits = places_of(texts).join(marked, ["_row", "term"]).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("order"), F.lit("term").alias("kind"), "end", F.col("term").alias("found")))).alias("extra"))
    # a text of many copies gets several keys, so that no task meets all of them
    parts = F.least(F.ceil(F.col("copies") / F.lit(COPIES)), F.lit(MOST_PARTS)).cast("long")
    hot = sized_broadcast(written(
        units.where(F.col("copies") > COPIES).join(sized_broadcast(marked.select("_row").distinct()), "_row", "left_semi")
        .select("_row", parts.alias("parts")), "hot"))
    known = F.coalesce("parts", F.lit(1).cast("long"))
    dealt = hits.join(hot, "_row", "left").select(
        "_row", "extra", F.explode(F.sequence(F.lit(0).cast("long"), known - 1)).alias("_part"))
    met = rows.join(hot, "_row", "left").withColumn("_part", F.pmod("_place", known))
    return met.join(dealt, ["_row", "_part"], "left").select(
        *(["_kept.*"] if kept else []), F.concat("spans", F.coalesce("extra", no_spans())).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with entities replaced by their kind, capitalised terms generalised to [NAME], terms with digits to
    [CODE], and other terms removed."""
    def instead(span, found):
        return (
            F.when(span["kind"] != "term", F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
            .when(found.rlike("[0-9]"), F.lit("[CODE]")).when(found.rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("")))

    return replaced(text, spans, instead)
