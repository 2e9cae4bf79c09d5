"""PII: information-theoretic sanitisation, in DataFrame functions only.

Personal data of four kinds are the protected entities (patterns below; a kind's matches are
the leftmost non-overlapping ones, then checked).  Over the corpus, a term t (a word in lower
case without punctuation around it) discloses an entity e by

    disclosure(t, e) = PMI(t; e) / IC(e) = log(P(t, e) / (P(t) P(e))) / -log P(e)

with probabilities by documents, wherever in a document the two stand: 1 means that a document
with the term is certain to hold the entity.  A term is to be generalised if for some entity its
disclosure is at least ``DISCLOSURE`` and the two meet in ``SUPPORT`` different contexts or more.
A document's context of an entity is the text within ``CONTEXT`` characters of it (of several
occurrences, the one whose hash is smallest), so copies of one passage are one context; it serves
for nothing else.  Every occurrence of such a term, in every document, is a span.  ``sanitise``
replaces entities by their kind and such terms by ``[TERM]``.

Counting: document frequencies are counted per word, over all documents.  The threshold bounds
how frequent a term of an entity can be (``_most_frequent``), so the words of documents that hold
an entity meet the counts before they meet the entities, and frequent words pair with nothing.

The match positions come from ``split`` (the text between matches) and ``regexp_extract_all``
(the matches), summed up by doubling steps (``_running``).  Patterns are written with possessive
quantifiers and anchored at the start of a run, which finds the same matches in linear time
without recursion.

Cases: null and empty texts have no spans (checksum of the empty string); a text of any length
is read whole; repeated rows count as documents each; a null ``doc_id`` stays null; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import _blocks as B

CONTEXT = 60
SUPPORT = 3
DISCLOSURE = 0.8

# Kinds in their order, with equivalent linear-time patterns.
WORD = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": f"(?:\\G|(?<![{WORD}]))[{WORD}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = list(PATTERNS)
OCTET = "^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\\.|$)){4}$"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.split(F.reverse(digits), "")

    def add(total: Column, i: Column) -> Column:
        d = F.get(back, i).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(OCTET)
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)


def _value(kind: str, m: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(m) if kind == "email" else m if kind == "ip"
                    else F.regexp_replace(m, "[^0-9]", ""))


def _running(lengths: Column) -> Column:
    """Running sums of an array of numbers.

    Step k adds to each number the one 2**k places before it, so a long array takes a few passes; an
    ``aggregate`` that appended to its result would copy it each time."""
    place = lambda k: F.call_function("shiftleft", F.lit(1), k)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths) + 1)).cast("int"))
    return F.aggregate(steps, lengths, lambda acc, k: F.transform(
        acc, lambda x, i: x + F.when(i >= place(k), F.get(acc, i - place(k))).otherwise(0)))


def _offsets(parts: Column, matches: Column) -> Column:
    """(match, end, context) of the matches, from the text between them; ``context`` is the hash of the
    text on both sides."""
    # zipped, not indexed: a lambda would split the text anew for every match
    sides = F.zip_with(parts, F.slice(parts, F.lit(2), F.size(matches)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    rows = F.zip_with(matches, F.slice(sides, F.lit(1), F.size(matches)),
                      lambda m, x: F.struct(m.alias("m"), x["p"].alias("p"), x["q"].alias("q")))
    ends = _running(F.transform(rows, lambda x: F.char_length(x["p"]) + F.char_length(x["m"])))
    return F.zip_with(rows, ends, lambda x, e: F.struct(
        x["m"].alias("m"), e.alias("e"),
        F.xxhash64(F.right(x["p"], F.lit(CONTEXT)), F.left(x["q"], F.lit(CONTEXT))).alias("context")))


SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string,context:bigint>>"


def _spans(kind: str, text: Column) -> Column:
    """Valid matches of a kind: (start, rank, kind, end, value, context)."""
    pattern = F.lit(PATTERNS[kind])
    found = _offsets(F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0)))
    good = F.filter(found, lambda x: _valid(kind, x["m"]))
    spans = F.transform(good, lambda x: F.struct(
        (x["e"] - F.char_length(x["m"])).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
        x["e"].alias("end"), _value(kind, x["m"]).alias("value"), x["context"].alias("context")))
    may = text.contains(NEEDS[kind]) if kind in ("email", "phone") else text.rlike("[0-9]")
    return F.when(may, spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


SPACES = "[\\x20\\x09-\\x0D]"


def _term(word: Column) -> Column:
    """A word in lower case without punctuation around it."""
    return F.regexp_replace(F.lower(word), "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", "")


def _terms(text: Column) -> Column:
    """The distinct terms of a text, of two characters at least."""
    return F.filter(F.array_distinct(F.transform(F.split(text, SPACES), _term)), lambda t: F.char_length(t) > 1)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of both."""
    rows = B.id_text(docs).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def entities(docs: DataFrame) -> DataFrame:
    """Per document its base spans in order and, if it has any, its terms."""
    rows = _keyed(docs)
    for kind in KINDS:
        rows = rows.withColumn(kind, _spans(kind, F.col("text")))
    rows = rows.select("doc_id", "key", "text", F.array_sort(F.concat(*KINDS)).alias("base"))
    return rows.select("doc_id", "key", "base", F.when(F.size("base") > 0, _terms(F.col("text"))).alias("terms"))


def _most_frequent(n_entity: Column, total: int) -> Column:
    """In how many documents a term can be that discloses an entity found in ``n_entity`` of them.

    disclosure >= D means P(t, e) / P(t) >= P(e) ** (1 - D), and the two meet in ``n_entity`` documents at most."""
    return n_entity * F.pow(F.lit(float(total)) / n_entity, F.lit(1.0 - DISCLOSURE))


def disclosing(spark: SparkSession, docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term) pairs whose disclosure and support reach the thresholds."""
    total = found.count()
    held = found.filter(F.size("base") > 0).select("key", "terms", F.col("base").alias("b"))
    each = held.select("key", F.explode("b").alias("x")).select("key", F.col("x.value").alias("entity"), F.col("x.context").alias("context"))
    # one row per document and entity: repeated rows of a document have one key, so their number is kept
    rows = held.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    of_doc = each.groupBy("key", "entity").agg(F.min("context").alias("context")).join(rows, "key")
    of_entity = (of_doc.groupBy("entity", "context").agg(F.sum("rows").alias("n"))
                 .groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("contexts"))
                 .filter((F.col("contexts") >= SUPPORT) & (F.col("n_entity") < total))
                 .select("entity", "n_entity", _most_frequent(F.col("n_entity"), total).alias("most")))
    of_entity = B.store(spark, of_entity, "entities-supported", free=False)
    most = of_entity.agg(F.max("most")).first()[0] or 0.0
    of_doc = B.store(spark, of_doc.join(of_entity, "entity"), "entities-of-documents", free=False)

    # counted per word before anything is joined: a frequent word sends one row per task
    of_term = (_keyed(docs).select(F.explode(_terms(F.col("text"))).alias("term"))
               .groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
               .filter((F.col("n_term") >= SUPPORT) & (F.col("n_term") <= most)))
    words = (held.join(of_doc.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
             .select("key", F.explode("terms").alias("term")).join(of_term, "term"))
    pairs = words.join(of_doc, "key").filter(F.col("n_term") <= F.col("most"))
    both = (pairs.groupBy("entity", "term", "n_term", "n_entity", "context").agg(F.sum("rows").alias("n"))
            .groupBy("entity", "term", "n_term", "n_entity").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("contexts"))
            .filter(F.col("contexts") >= SUPPORT))
    p = lambda c: F.col(c) / F.lit(float(max(total, 1)))
    gain = F.log(p("both") / (p("n_term") * p("n_entity"))) / -F.log(p("n_entity"))
    return both.filter(gain >= DISCLOSURE).select("entity", "term")


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, words): the words of each document whose term is one of ``terms``, as (start, end)."""
    rows = _keyed(docs).select("key", "text")
    holding = (rows.select("key", F.explode(_terms(F.col("text"))).alias("term")).join(terms, "term", "left_semi")
               .groupBy("key").agg(F.collect_set("term").alias("held")))
    words = F.split(F.col("text"), SPACES, -1)
    ends = _running(F.transform(words, lambda w: F.char_length(w) + 1))
    placed = F.zip_with(words, ends, lambda w, e: F.struct(
        (e - 1 - F.char_length(w)).alias("start"), (e - 1).alias("end"), _term(w).alias("term")))
    return (rows.join(holding, "key").dropDuplicates(["key"])
            .select("key", F.filter(placed, lambda w: F.array_contains("held", w["term"])).alias("words")))


def spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document ``doc_id``, ``key``, ``base`` and ``all`` spans (start, rank, kind, end), in order.

    A word that overlaps a base span is no span of its own."""
    found = B.store(spark, entities(docs), "entities", free=False)
    told = B.store(spark, disclosing(spark, docs, found).select("term").distinct(), "terms", free=False)
    kind = "array<struct<start:int,rank:int,kind:string,end:int>>"
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"),
                                                   b["kind"].alias("kind"), b["end"].alias("end"))).cast(kind)
    rows = found.select("doc_id", "key", plain.alias("base"))
    if told.isEmpty():
        return rows.select("doc_id", "key", "base", F.col("base").alias("all"))
    clear = F.filter("words", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (b["end"] > w["start"])))
    more = F.transform(clear, lambda w: F.struct(w["start"].alias("start"), F.lit(len(KINDS)).alias("rank"),
                                                 F.lit("term").alias("kind"), w["end"].alias("end"))).cast(kind)
    return (rows.join(occurrences(docs, told), "key", "left")
            .select("doc_id", "key", "base", F.array_sort(F.concat("base", F.coalesce(more, F.array().cast(kind)))).alias("all")))


def _joined(column: str) -> Column:
    return F.concat_ws(",", F.transform(column, lambda b: F.concat_ws(
        ":", b["kind"], b["start"].cast("string"), b["end"].cast("string"))))


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans(spark, docs).select("doc_id", *(count(k) for k in KINDS),
                                     F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("all").alias("spans"))


def sanitise(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with entities generalised to their kind and disclosing terms to ``[TERM]``.

    Where spans overlap, the one that starts first is generalised and the others in it are dropped with it.
    """
    marks = spans(spark, docs).filter(F.size("all") > 0).select("key", "all").dropDuplicates(["key"])
    own = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.col("doc_id").cast("long"), own).alias("key"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))

    def step(acc: Column, b: Column) -> Column:
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, b["start"] - acc["at"]), F.lit("["),
                       F.upper(b["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"),
                        F.when(b["start"] >= acc["at"], out).otherwise(acc["out"]).alias("out"))

    new = F.aggregate("all", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                      lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    made = F.when(F.col("all").isNull(), F.col("row.text")).otherwise(new)
    return (rows.join(marks, "key", "left").select("row", F.struct(made.alias("text")).alias("made"))
            .select(*(F.col("made.text" if c == "text" else f"row.{c}").alias(c) for c in docs.columns)))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(spark, B.table(spark, sf_dir, "documents"))
