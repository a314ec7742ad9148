"""Personal data: pattern spans, and information-theoretic sanitisation of the terms in their documents.

Base spans are the leftmost non-overlapping matches of four patterns; their values are the protected entities. A term in an
entity's documents tells of it as much as corpus co-occurrence says: with N documents, n(t) of them with the term t, n(e)
distinct ones with the entity e and n(t,e) of these with t anywhere outside base spans, the disclosed share of e's
information content is

    PMI(t; e) / IC(e) = log2(n(t,e) N / (n(t) n(e))) / log2(N / n(e)),

which is 1 where t occurs with e alone. Terms at or above ``generalise`` become spans of kind ``term`` (in a redacted text
a class stands for them), those at or above ``remove`` of kind ``drop`` (taken out), wherever they stand in documents with
the entity. An entity's documents count as distinct by the two words on either side of it (one place a document), so that
copies of a text are no evidence, and n(t,e) below ``support`` counts as none.

Only DataFrame functions are used. Offsets are in code points, the end exclusive.

Edge cases: null text counts as empty and has no span; empty tables give an empty result; every row of a repeated doc_id is
treated by itself; other columns are passed on by ``redact`` and ignored by ``detect``. Characters U+E000 to U+E002 in a
text are read as one that no pattern knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import materialise

OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"
_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns, with bounds where no other start can match earlier and possessive repeats where giving back cannot
#: help: the same matches, in time that is linear in the text.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Runs of 13 to 19 digits; shorter and longer runs are dropped in any case.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORD = r"[\p{L}\p{M}\p{N}]++"
KINDS = ("email", "ip", "card", "phone")
#: Code points on either side of an entity that its two neighbouring words are taken from.
REACH = 100
#: Code points of a piece of a text (see _cut).
CHUNK = 512
GENERALISE, REMOVE, SUPPORT = 0.8, 0.95, 3
#: Distinct terms whose list is broadcast; a longer list is joined by a shuffle, to the same result.
BROADCAST_TERMS = 500_000


def _bound(value: Column, use) -> Column:
    """use(value) with the value computed once, which an expression inside a lambda is not."""
    return F.transform(F.array(value), use)[0]


def _fold(items: Column, start: Column, step, kind: str) -> Column:
    """step(place, item) gives (p, v): the next place and a value of type ``kind``. Returns the last place and all values in
    order, as (p, o). Values are appended in blocks of about the square root of their number, so that many take no long copies."""
    empty = F.array().cast(f"array<{kind}>")

    def add(a: Column, x: Column) -> Column:
        return _bound(step(a["p"], x), lambda r: F.struct(r["p"].alias("p"), F.concat(a["o"], F.array(r["v"])).alias("o")))

    def add_block(a: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(a["p"].alias("p"), empty.alias("o")), add)
        return _bound(inner, lambda r: F.struct(r["p"].alias("p"), F.concat(a["o"], F.array(r["o"])).alias("o")))

    def blocks(every: Column) -> Column:
        k = F.greatest(F.ceil(F.sqrt(F.size(every))), F.lit(1)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(every) / k), F.lit(1)).cast("int") - 1), lambda i: F.slice(every, i * k + 1, k))
        return F.aggregate(parts, F.struct(start.alias("p"), F.array().cast(f"array<array<{kind}>>").alias("o")), add_block, lambda a: F.struct(a["p"].alias("p"), F.flatten(a["o"]).alias("o")))

    return _bound(items, blocks)


def _chunks(text: Column) -> Column:
    """A text in pieces of CHUNK code points, from which _cut takes a part without walking through all before it."""
    return F.regexp_extract_all(text, F.lit(rf"((?s:.{{1,{CHUNK}}}))"), F.lit(1))


def _cut(chunks: Column, start: Column, length: Column) -> Column:
    first = F.floor(start / CHUNK).cast("int")
    held = F.slice(chunks, first + 1, F.floor((start + length) / CHUNK).cast("int") - first + 1)
    return F.when(length > 0, F.substring(F.array_join(held, ""), start - first * CHUNK + 1, length)).otherwise("")


def _found(text: Column, pattern: str, maybe: Column) -> Column:
    """Matches as (s, e, v). The text gets marks around matches and is cut at them; each piece then tells its place."""
    marked = F.regexp_replace(text, f"({pattern})", f"{OPEN}$1{CLOSE}")
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")

    def step(p: Column, piece: Column) -> Column:
        value = F.substring_index(piece, CLOSE, 1)
        one = F.struct(p.alias("s"), (p + F.length(value)).alias("e"), value.alias("v"))
        return F.struct((p + F.length(piece) - 1).alias("p"), one.alias("v"))

    placed = _bound(F.split(marked, OPEN), lambda x: _fold(F.slice(x, 2, F.size(x) - 1), F.length(x[0]), step, "struct<s:int,e:int,v:string>")["o"])
    return F.when(maybe, placed).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """Base spans by kind, as arrays of (s, e, v)."""
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    ip = _found(text, IP, text.rlike(IP))
    card = _found(text, CARD, text.rlike(CARD))
    phone = _found(text, PHONE, F.contains(text, F.lit("+")) & text.rlike(PHONE))
    return {
        "email": _found(text, EMAIL, F.contains(text, F.lit("@")) & text.rlike(EMAIL)),
        "ip": F.filter(ip, lambda x: x["v"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
        "card": F.filter(card, lambda x: F.call_function("luhn_check", digits(x["v"]))),
        "phone": F.filter(phone, lambda x: F.length(digits(x["v"])).between(9, 15)),
    }


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE, OTHER * 2)


def _outside(text: Column, spans: Column) -> Column:
    """The text with a line break for each base span."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))

    def rest(chunks: Column) -> Column:
        step = lambda p, x: F.struct(F.greatest(p, x["e"]).alias("p"), _cut(chunks, p, x["s"] - p).alias("v"))
        return _bound(_fold(order, F.lit(0), step, "string"), lambda a: F.array_join(F.concat(a["o"], F.array(F.substring(text, a["p"] + 1, F.length(text)))), "\n"))

    return _bound(_chunks(text), rest)


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"))


def _places(text: Column, kinds: Column) -> Column:
    """Places (s, e, kind) of the words of a text that a map from words to kinds holds."""
    pieces = F.regexp_extract_all(text, F.lit(rf"({_WORD}|[^\p{{L}}\p{{M}}\p{{N}}]++)"), F.lit(1))

    def step(p: Column, piece: Column) -> Column:
        e = p + F.length(piece)
        return F.struct(e.alias("p"), F.struct(p.alias("s"), e.alias("e"), F.element_at(kinds, F.lower(piece)).alias("kind")).alias("v"))

    return F.filter(_fold(pieces, F.lit(0), step, "struct<s:int,e:int,kind:string>")["o"], lambda x: x["kind"].isNotNull())


def _terms(docs: DataFrame, marked: DataFrame, generalise: float, remove: float, support: int) -> DataFrame:
    """Terms to take out: _row, kinds (a map from terms to kinds). docs: every text; marked: rows with spans (kind, s, e, v,
    left, right) and their text."""
    spark = docs.sparkSession
    entity = marked.select("_row", F.explode("spans").alias("x")).select("_row", F.lower("x.v").alias("entity"), F.lower("x.left").alias("left"), F.lower("x.right").alias("right"))
    near = F.concat_ws(" ", F.array_join(F.slice(F.regexp_extract_all("left", F.lit(f"({_WORD})"), F.lit(1)), -2, 2), " "), F.lit("|"), F.array_join(F.slice(F.regexp_extract_all("right", F.lit(f"({_WORD})"), F.lit(1)), 1, 2), " "))
    held = entity.groupBy("_row", "entity").agg(F.min(F.xxhash64(near)).alias("context"))
    n_e = held.groupBy("entity", "context").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("n_e"))
    # n(t,e) is at most n(e), so that rarer entities disclose nothing
    held = materialise(spark, held.join(n_e.where(F.col("n_e") >= support), "entity"), "held")
    total = docs.agg(F.count("*").alias("n"))  # one row

    def share(n_te: Column, n_t: Column) -> Column:
        return F.try_divide(F.log2(n_te * F.col("n") / (F.greatest(n_t, n_te) * F.col("n_e"))), F.log2(F.col("n") / F.col("n_e")))

    # of the terms in documents with an entity, how many of these documents have them: what n(t) is at least
    with_terms = marked.join(held.select("_row").distinct(), "_row", "left_semi").select("_row", _outside(F.col("_text"), F.col("spans")).alias("_out"))
    seen = materialise(spark, with_terms.select("_row", F.explode(_distinct_words(F.col("_out"))).alias("term")).where("term != ''"), "seen")
    least = seen.groupBy("term").agg(F.count("*").alias("least")).where(F.col("least") >= support)
    # no entity of that many documents is disclosed by a term of so many
    top = held.agg(F.max("n_e").alias("n_e")).crossJoin(total)
    least = least.crossJoin(F.broadcast(top)).where((F.col("n") <= F.col("n_e")) | (share(F.col("n_e"), F.col("least")) >= generalise)).select("term", "least")
    pairs = seen.join(least, "term").join(held, "_row").crossJoin(F.broadcast(total)).where((F.col("n") > F.col("n_e")) & (share(F.col("n_e"), F.col("least")) >= generalise))
    each = pairs.groupBy("entity", "term", "context").agg(F.max("n_e").alias("n_e"), F.max("least").alias("least"), F.max("n").alias("n"))
    joint = each.groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.max("n_e").alias("n_e"), F.max("least").alias("least"), F.max("n").alias("n"))
    joint = materialise(spark, joint.where((F.col("n_te") >= support) & (share(F.col("n_te"), F.col("least")) >= generalise)), "joint")
    candidates = joint.select("term").distinct()
    if candidates.count() <= BROADCAST_TERMS:
        candidates = F.broadcast(candidates)
    own = docs.select(F.explode(_distinct_words(F.col("text"))).alias("term"))
    of_term = own.join(candidates, "term").groupBy("term").agg(F.count("*").alias("n_t"))
    disclosing = joint.join(of_term, "term").select("entity", "term", share(F.col("n_te"), F.col("n_t")).alias("share")).where(F.col("share") >= generalise)
    kind = F.when(F.max("share") >= remove, "drop").otherwise("term")
    found = held.select("_row", "entity").join(disclosing, "entity").groupBy("_row", "term").agg(kind.alias("kind"))
    return found.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("kinds"))


def _spans(text: Column) -> Column:
    """All base spans in order with their surroundings: kind, s, e, v, left, right."""
    def around(kind: str, chunks: Column):
        return lambda x: F.struct(
            F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"),
            _cut(chunks, F.greatest(x["s"] - REACH, F.lit(0)), F.least(x["s"], F.lit(REACH))).alias("left"),
            _cut(chunks, x["e"], F.lit(REACH)).alias("right"))

    found = base_spans(text)
    # most texts have no span and are not cut
    some = F.coalesce(*[F.when(F.size(v) > 0, True) for v in found.values()], F.lit(False))
    return _bound(F.when(some, _chunks(text)).otherwise(F.array().cast("array<string>")), lambda chunks: F.concat(*[F.transform(v, around(kind, chunks)) for kind, v in found.items()]))


def detect(spark: SparkSession, docs: DataFrame, keep: list[str] = ["doc_id"], generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:  # noqa: B006
    """The kept columns of every row with ``base`` and ``terms``: arrays of (kind, s, e), base spans by kind as in KINDS and
    then by place, term spans by place without those that touch a base span."""
    own = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], _clean(F.col("text")).alias("_text"))
    rows = own.select(*own.columns, F.monotonically_increasing_id().alias("_row"), _spans(F.col("_text")).alias("spans"))
    rows = rows.withColumn("_text", F.when(F.size("spans") > 0, F.col("_text")))
    stored = materialise(spark, rows, "spans")
    marked = stored.where(F.size("spans") > 0)
    kinds = _terms(docs.select("text"), marked.select("_row", "_text", "spans"), generalise, remove, support)
    lists = marked.select("_row", "_text").join(kinds, "_row").select("_row", _places(F.col("_text"), F.col("kinds")).alias("t"))
    both = stored.select("_row", *[c for c in stored.columns if c.startswith("_k")], F.transform("spans", lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"))).alias("base")).join(lists, "_row", "left")
    clear = F.filter(F.coalesce("t", F.array().cast("array<struct<s:int,e:int,kind:string>>")), lambda t: ~F.exists("base", lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])))
    terms_out = F.transform(clear, lambda t: F.struct(t["kind"].alias("kind"), t["s"].alias("s"), t["e"].alias("e")))
    return both.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "base", terms_out.alias("terms"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


#: What stands for a span in a redacted text; a number among the generalised terms keeps its class.
STANDS_FOR = {"email": "[email]", "ip": "[ip]", "card": "[card]", "phone": "[phone]", "term": "[term]", "drop": ""}


def redact(spark: SparkSession, docs: DataFrame, **settings: float) -> DataFrame:
    """docs with every span replaced by what stands for it; of spans that overlap, the first one (the longer at a tie)
    takes the place. All columns stay; n_chars, if there, follows the text."""
    columns = docs.columns
    found = detect(spark, docs, columns, **settings)
    order = F.array_sort(F.transform(F.concat("base", "terms"), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("m"), x["kind"].alias("kind"))))
    text = F.col("text")
    stands = F.create_map(*[F.lit(x) for pair in STANDS_FOR.items() for x in pair])

    def replaced(chunks: Column) -> Column:
        def step(p: Column, x: Column) -> Column:
            free = x["s"] >= p
            out = F.concat(_cut(chunks, p, x["s"] - p), F.element_at(stands, x["kind"]))
            return F.struct(F.when(free, -x["m"]).otherwise(p).alias("p"), F.when(free, out).otherwise("").alias("v"))

        return _bound(_fold(order, F.lit(0), step, "string"), lambda a: F.concat(F.array_join(a["o"], ""), F.substring(text, a["p"] + 1, F.length(text))))

    whole = _bound(_chunks(text), replaced)
    clean = F.when(F.size("base") + F.size("terms") > 0, whole).otherwise(text)
    out = found.withColumn("_clean", clean)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size("base") + F.size("terms") > 0, F.length("_clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("_clean")).select(*columns)
