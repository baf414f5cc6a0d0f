"""Personal data in texts: known forms, and further identifiers found by bootstrapping.

The known forms (e-mail, IP address, card and phone number) are the seeds. The label before a value, a
word or what stands glued to it (`phone=`, `"tel":"`), is a lexical pattern, (kind, label). Patterns and the
values they precede form a graph that is scored in rounds: a pattern is as credible as the share of all
occurrences of its label that is followed by a credible value of its kind; a value that is no seed is as
credible as its patterns together. Each round induces patterns anew, from the seeds and the values that
the patterns so far made credible, until a round adds none. Loose forms (numbers in other notations,
addresses without a full domain) that follow a credible pattern are reported as well. All of it is SQL
expressions and joins.
"""

from __future__ import annotations



from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE_CLASS, staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that a long run of matching characters is tried once only.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth trying.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
#: Loose forms, and what they need to pass as a value of a kind.
_FREE = r"\x20\x09-\x0D\"'<>,;()="
LOOSE = rf"(?<![^{_FREE}])[^{_FREE}@]++@[^{_FREE}]++|[(+]?[0-9][0-9().:/\x20-]{{4,}}[0-9]"
#: A mark that no text holds (it is replaced where one does), so that a text can be split at it.
MARK, INSTEAD = "￿", "￾"
#: Labels: words, with the quote and the colons or equals signs after them. The same expression finds the
#: label before a value and counts all labels of the corpus.
_PART = r"[^\x20\x09-\x0D\"'()<>\[\]{},;&|=:]"
LABEL = rf"{_PART}++[\"']?+[=:]*+"
LEFT_LABEL = rf"((?<!{_PART}){LABEL}){SPACE_CLASS}*+[\"'(<\[]*+$"
#: Characters before a value in which its label is looked for.
BEFORE = 120
#: Different values a pattern must precede; credibility to count and to report.
SUPPORT, CREDIBLE = 3, 0.6
FOUND = "array<struct<kind:string,start:int,end:int,value:string,word:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a number of at most 19 digits is right."""
    back = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((2 * c.cast("int")) % 10 + F.floor(c.cast("int") / 5).cast("int"))
    return F.aggregate(F.transform(back, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return F.when(F.length(_digits(value)).between(13, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, kind: str, pattern: str, valid) -> Column:
    """Matches of a pattern with their places, as FOUND: the text is split at marks around them, and
    running lengths give the positions."""
    parts = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    parts = F.transform(parts, lambda p, i: F.struct(p.alias("part"), F.length(p).alias("chars"), (i % 2 == 1).alias("inside")))

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + p["chars"]
        hit = F.struct(
            F.lit(kind).alias("kind"),
            acc["at"].alias("start"),
            end.alias("end"),
            p["part"].alias("value"),
            F.lower(F.regexp_extract(F.right(acc["before"], F.lit(BEFORE)), LEFT_LABEL, 1)).alias("word"),
        )
        hits = F.when(p["inside"] & valid(p["part"]), F.concat(acc["hits"], F.array(hit))).otherwise(acc["hits"])
        return F.struct(end.alias("at"), p["part"].alias("before"), hits.alias("hits"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.array().cast(FOUND).alias("hits"))
    return F.aggregate(parts, start, step, lambda acc: acc["hits"])


def find_known(text: Column) -> Column:
    """The base spans of a text, by kind, then start."""
    none = F.array().cast(FOUND)
    found = [
        F.when(text.rlike(NEEDS[k]), _matches(text, k, PATTERNS[k], lambda v, k=k: _valid(k, v))).otherwise(none) for k in KINDS
    ]
    return F.concat(*found)


def find_loose(text: Column, known: Column) -> Column:
    """Loose forms that overlap no known span."""
    free = lambda c: ~F.exists(known, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    found = _matches(text, "", LOOSE, lambda v: F.lit(True))
    return F.when(text.rlike("[@0-9]"), F.filter(found, free)).otherwise(F.array().cast(FOUND))


def could_be(kind: Column, value: Column) -> Column:
    """Whether a loose form may be a value of a kind."""
    digits = F.length(_digits(value))
    number = ~value.contains("@")
    return (
        F.when(kind == "email", ~number)
        .when(kind == "ip", number & F.regexp_like(value, F.lit(r"^[0-9]+([.:][0-9]+){3,}$")))
        .when(kind == "card", number & digits.between(12, 19))
        .otherwise(number & digits.between(7, 15))
    )


def scored_patterns(found: DataFrame, text_words: DataFrame, support: int = SUPPORT) -> DataFrame:
    """`kind`, `word`, `credit` of every credible pattern.

    `found`: `known` and `loose` spans; `text_words`: the column `word`, one row per label of the
    corpus. Values and labels are counted before anything is joined, so a frequent one is one row. What
    is credible only grows from round to round, and the rounds end when no pattern is added.
    """
    seeds = found.select(F.explode("known").alias("s")).select("s.kind", "s.word", F.lower("s.value").alias("value"))
    seeds = seeds.where("word != ''").groupBy("kind", "word", "value").agg(F.count("*").alias("n")).withColumn("seed", F.lit(True))
    loose = found.select(F.explode("loose").alias("s")).select("s.word", F.lower("s.value").alias("value"))
    loose = loose.where("word != ''").groupBy("word", "value").agg(F.count("*").alias("n"), F.lit(False).alias("seed"))
    kinds = F.filter(F.array(*map(F.lit, KINDS)), lambda k: could_be(k, F.col("value")))
    loose = loose.withColumn("kind", F.explode(kinds)).select("kind", "word", "value", "n", "seed")
    # a label before fewer values than the support is no pattern in any round
    edges = seeds.unionByName(loose)
    enough = edges.groupBy("kind", "word").agg(F.count("*").alias("values")).where(F.col("values") >= support).drop("values")
    edges = edges.join(enough, ["kind", "word"])
    totals = text_words.groupBy("word").agg(F.count("*").alias("total"))
    edges = staged(edges.join(totals, "word"), "edges")
    worth, before = edges.withColumn("worth", F.col("seed").cast("double")), -1
    while True:
        patterns = worth.groupBy("kind", "word").agg(
            F.sum(F.col("n") * F.col("worth")).alias("hits"),
            F.sum((F.col("worth") >= CREDIBLE).cast("int")).alias("values"),
            F.first("total").alias("total"),
        )
        credit = F.least(F.lit(1.0), F.col("hits") / F.col("total"))
        patterns = staged(patterns.where(F.col("values") >= support).select("kind", "word", credit.alias("credit")), "patterns")
        credible = patterns.where(F.col("credit") >= CREDIBLE)
        if (now := credible.count()) == before:
            return credible
        before = now
        doubt = F.sum(F.log(F.greatest(1.0 - F.col("credit"), F.lit(1e-9))))
        values = edges.where("not seed").join(patterns, ["kind", "word"]).groupBy("kind", "value").agg((1.0 - F.exp(doubt)).alias("belief"))
        worth = edges.join(values, ["kind", "value"], "left").withColumn(
            "worth", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("belief", F.lit(0.0)))
        )


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False
) -> DataFrame:
    """Per row of `docs`: `id_col`, `base` and `spans`, arrays of (kind, start, end, value), by kind, then start.

    `base` has the known forms, `spans` also those of credible patterns. Positions are code points,
    ends exclusive. Null and empty texts have none. Repeated rows and null ids come back as they
    are; an empty table gives none. Long words and texts are read once per expression. With `keep_text`, also `row`, the input row.
    """
    text = F.translate(text_or_empty("_text"), MARK, INSTEAD)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *([F.struct(*docs.columns).alias("row")] if keep_text else []))
    rows = rows.withColumn("key", F.monotonically_increasing_id()).withColumn("_text", text)
    rows = rows.withColumn("known", find_known(F.col("_text")))
    rows = rows.withColumn("loose", find_loose(F.col("_text"), F.col("known"))).drop("_text")
    rows = staged(rows, "personal")  # the keys of rows hold from here on
    said = docs.select(F.explode(F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(LABEL), 0)).alias("word"))
    patterns = scored_patterns(rows, said)
    more = rows.select("key", F.explode("loose").alias("s")).where("s.word != ''")
    more = more.join(patterns, F.col("s.word") == F.col("word")).where(could_be(F.col("kind"), F.col("s.value")))
    best = F.max_by(F.struct("kind", "s.start", "s.end", "s.value"), F.struct("credit", "kind"))
    more = more.groupBy("key", "s.start").agg(best.alias("hit")).groupBy("key").agg(F.collect_list("hit").alias("more"))
    rows = rows.join(more, "key", "left")
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    place = lambda kind: F.array_position(F.array(*map(F.lit, KINDS)), kind)
    every = F.concat(plain("known"), F.coalesce(plain("more"), F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")))
    keyed = F.array_sort(F.transform(every, lambda s: F.struct(place(s["kind"]).alias("k"), s["start"].alias("at"), s.alias("s"))))
    spans = F.transform(keyed, lambda x: x["s"])
    return rows.select(F.col("_id").alias(id_col), plain("known").alias("base"), spans.alias("spans"), *(["row"] if keep_text else []))


def mask_personal_data(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """`docs` with every span in its text replaced by its kind in angle brackets; overlapping spans
    become one, under the name of the first."""
    found = find_personal_data(docs, docs.columns[0], text_col, keep_text=True).select("row", "spans")
    text = F.col("row")[text_col]
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1, F.length(text)))
    masked = F.when(F.size("spans") == 0, text).otherwise(F.aggregate(ordered, start, step, rest))
    found = found.withColumn("masked", masked)
    new = {text_col: F.col("masked"), n_chars_col: F.length("masked").cast("long")}
    return found.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def span_text(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
