"""Personal data: patterns find identifiers, corpus co-occurrence finds the words that give them away.

Base spans come from four patterns (e-mail, IP address, card, phone) with their checks; matches
that fail a check are dropped without a retry.  Positions are the lengths of the pieces that
split() leaves between the matches.  The patterns are written with possessive repetition, so a
long run of digits or letters costs linear time and no recursion.

Then the information-theoretic part.  Entities are the checked identifiers; a term is a word of
at least ``min_chars`` that isn't part of one.  Over the corpus (documents with equal text count
once), n(t, e) is the number of documents that hold both t and e, anywhere in them, n(t) and n(e)
the documents holding t and e.  A term discloses e if P(e | t) = n(t, e) / n(t) >= ``min_share``,
its pointwise mutual information log2(n(t, e) N / (n(t) n(e))) >= ``min_bits`` and n(t, e) >=
``min_support``.  A term that discloses any e becomes a span of kind ``term`` wherever it stands,
in documents without e too; ``sanitise`` generalises identifiers to their kind and removes
disclosing terms.

n(t, e) is at most n(t) and at most n(e), so words and identifiers in fewer than ``min_support``
documents or in more than N / 2^min_bits can't pass, nor a pair with n(e) < ``min_share`` n(t):
they are left out before pairs are made.  Texts are exchanged once, to count each once; word
counts are combined on the map side (one row per task and word).  Occurrences are found in a map:
a bit map of the terms' hashes (bounded size) picks words, an exact join confirms them.  The
identifiers found and the words beside them are checkpointed.

Defined cases: null or empty text has no spans; rows with equal doc_id and text get equal spans;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, WORD, documents, equal_keys, let, text_of, words_of

KINDS = ("email", "ip", "card", "phone")
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# A match can start only where a run of its characters starts (or right after a match): elsewhere
# the start of that run would have matched as well.  This keeps the search linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MIN_SUPPORT, MIN_SHARE, MIN_BITS, MIN_CHARS = 3, 0.5, 4.0, 4
BUCKETS = 1 << 18
_PART = WORD + "+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    return {"email": lambda: F.lit(True),
            "ip": lambda: value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
            "card": lambda: F.when(n.between(13, 19), _luhn(_digits(value))).otherwise(F.lit(False)),
            "phone": lambda: n.between(9, 15)}[kind]()


def _found(kind: str, text: Column) -> Column:
    """Array of (k, s, e, v): kind number, start, end (code points) and text of valid matches."""
    pattern = PATTERNS[kind]
    span = "array<struct<k:int,s:int,e:int,v:string>>"

    def place(both: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {span})").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            hit = F.get(both.hits, i)
            start = acc.at + F.length(F.get(both.gaps, i))
            return F.struct((start + F.length(hit)).alias("at"), F.concat(acc.out, F.array(F.struct(
                F.lit(KINDS.index(kind)).alias("k"), start.alias("s"), (start + F.length(hit)).alias("e"), hit.alias("v")))).alias("out"))

        n = F.size(both.hits)
        return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), first, step, lambda a: a.out))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    some = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike(r"[0-9]\.[0-9]"),
            "card": text.rlike(r"[0-9][\x20-]?[0-9]")}[kind]
    placed = F.when(some, let(both, place))
    return F.coalesce(F.filter(placed, lambda x: _valid(kind, x.v)), F.expr(f"cast(array() as {span})"))


def _hash(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _words_beside(text: Column, spans: Column) -> Column:
    """The different words of a text that are not part of a span."""
    def after(at: Column) -> Column:
        return F.regexp_replace(F.substring(text, at + 1, F.length(text)), rf"\A{_PART}", "")

    def step(acc: Column, x: Column) -> Column:
        piece = F.substring(text, acc.at + 1, F.greatest(F.lit(0), x.s - acc.at))
        whole = F.when(acc.at > 0, F.regexp_replace(piece, rf"\A{_PART}", "")).otherwise(piece)
        return F.when(x.e <= acc.at, acc).otherwise(F.struct(x.e.alias("at"), F.concat(
            acc.out, F.lit(" "), F.regexp_replace(whole, rf"(?<!{WORD[:-1]}){_PART}\z", "")).alias("out")))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    places = F.array_sort(F.transform(spans, lambda x: F.struct(x.s.alias("s"), x.e.alias("e"))))
    rest = F.aggregate(places, first, step, lambda acc: F.concat(acc.out, F.lit(" "), after(acc.at)))
    return F.array_distinct(words_of(rest))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, spans, words): spans are (k, s, e, v); words are those beside the spans, null
    for a document without any."""
    text = text_of()
    rows = docs.select("doc_id", _hash(text).alias("hash"), text.alias("text"), F.concat(*[_found(k, text) for k in KINDS]).alias("spans"))
    return rows.select("doc_id", "hash", "spans", F.when(F.size("spans") > 0, _words_beside(F.col("text"), F.col("spans"))).alias("words"))


def _places(text: Column, some: Callable[[Column], Column]) -> Column:
    """(t, s, e) of the words of a text for which ``some`` holds."""
    both = F.struct(words_of(text).alias("w"), F.split(text, WORD, -1).alias("gaps"))
    empty = "array<struct<t:string,s:int,e:int>>"

    def place(b: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {empty})").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            w, start = F.get(b.w, i), acc.at + F.length(F.get(b.gaps, i))
            end = start + F.length(w)
            return F.struct(end.alias("at"), F.when(some(w), F.concat(acc.out, F.array(F.struct(
                w.alias("t"), start.alias("s"), end.alias("e"))))).otherwise(acc.out).alias("out"))

        return F.when(F.exists(b.w, some), F.aggregate(F.sequence(F.lit(0), F.size(b.w) - 1), first, step, lambda a: a.out))

    return let(both, place)


def strong_terms(docs: DataFrame, found: DataFrame, min_support: int = MIN_SUPPORT, min_share: float = MIN_SHARE,
                 min_bits: float = MIN_BITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """t: the words that disclose an identifier."""
    n_docs = found.select("hash").distinct().count()
    most = n_docs / 2 ** min_bits
    held = found.where(F.size("spans") > 0).select("hash", "words", F.array_distinct(F.transform(
        "spans", lambda x: F.struct(x.k.alias("k"), x.v.alias("v")))).alias("es")).dropDuplicates(["hash"])
    hits = held.select("hash", F.explode("es").alias("x")).select("hash", F.col("x.k").alias("k"), F.col("x.v").alias("v"))
    entities = (hits.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e").between(min_support, most))
                .select(F.col("k").alias("ek"), F.col("v").alias("ev"), "n_e"))
    near = (hits.join(entities, (F.col("k") == F.col("ek")) & (F.col("v") == F.col("ev")))
            .groupBy(F.col("hash").alias("nh")).agg(F.collect_list(F.struct("ek", "ev", "n_e")).alias("near")))
    # documents with equal text count once: one row per text, then one per word and task
    text = text_of()
    once = docs.select(_hash(text).alias("hash"), text.alias("text")).select("hash.a", "hash.b", "text").dropDuplicates(["a", "b"])
    n_t = (once.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("t")).where(F.length("t") >= min_chars)
           .groupBy("t").agg(F.count(F.lit(1)).alias("n_t")).where(F.col("n_t").between(min_support, most))
           .select(F.col("t").alias("nt"), "n_t"))
    words = (held.select("hash", "words").join(near, F.col("hash") == F.col("nh"))
             .select("near", F.explode("words").alias("t")).where(F.length("t") >= min_chars))
    pairs = (words.join(n_t, F.col("t") == F.col("nt"))
             .select("t", "n_t", F.explode(F.filter("near", lambda x: x.n_e >= min_share * F.col("n_t"))).alias("x")))
    joint = pairs.groupBy("t", "n_t", "x").agg(F.count(F.lit(1)).alias("n_te"))
    n_e = F.col("x.n_e")
    return joint.where((F.col("n_te") >= min_support) & (F.col("n_te") >= min_share * F.col("n_t"))
                       & (F.log2(F.col("n_te") * F.lit(float(n_docs)) / (F.col("n_t") * n_e)) >= min_bits)).select("t").distinct()


def term_spans(docs: DataFrame, found: DataFrame, **options) -> DataFrame:
    """(doc_id, hash, terms): places (s, e) of the disclosing terms of each document."""
    strong = strong_terms(docs, found, **options).checkpoint(eager=True)
    bucket = lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS))
    bits = [0] * (BUCKETS // 32)
    for r in strong.select(bucket(F.col("t")).alias("b")).distinct().collect():  # bounded
        bits[r.b // 32] |= 1 << r.b % 32
    table = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<long>")
    may = lambda w: let(bucket(w), lambda b: F.getbit(F.get(table, F.shiftright(b, 5).cast("int")), F.pmod(b, F.lit(32)).cast("int")) == 1)
    text = text_of()
    at = docs.select("doc_id", _hash(text).alias("hash"), F.explode(_places(text, may)).alias("w")).select("doc_id", "hash", "w.*")
    at = at.join(strong.select(F.col("t").alias("st")), F.col("t") == F.col("st"), "left_semi")
    return at.groupBy("doc_id", "hash").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("terms"))


def spans_of(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, spans, terms) of every document."""
    found = find(docs).checkpoint(eager=True)
    terms = term_spans(docs, found, **options).select(F.col("doc_id").alias("td"), F.col("hash").alias("th"), "terms")
    rows = found.join(terms, equal_keys(found, terms, [("doc_id", "td"), ("hash", "th")]), "left")
    # a word that is part of an identifier is already covered
    free = F.filter("terms", lambda t: ~F.exists("spans", lambda x: (t.s < x.e) & (t.e > x.s)))
    return rows.select("doc_id", "hash", "spans", F.coalesce(free, F.expr("cast(array() as array<struct<s:int,e:int>>)")).alias("terms"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """Documents with identifiers generalised to ``[kind]`` and disclosing terms removed.  An
    identifier that overlaps one of an earlier kind or start goes with it."""
    marked = spans_of(docs, **options)
    marked = marked.select(F.col("doc_id").alias(f"{OWN}d"), F.col("hash").alias(f"{OWN}h"), F.array_sort(F.concat(
        F.transform("spans", lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), F.concat(
            F.lit("["), F.element_at(F.array(*[F.lit(k) for k in KINDS]), x.k + 1), F.lit("]")).alias("r"))),
        F.transform("terms", lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), F.lit("").alias("r"))))).alias(f"{OWN}m"))
    marked = marked.dropDuplicates([f"{OWN}d", f"{OWN}h"]).where(F.size(f"{OWN}m") > 0)
    rows = docs.withColumn(f"{OWN}key", F.struct(F.xxhash64(text_of()).alias("a"), F.xxhash64(F.lit(1), text_of()).alias("b")))
    rows = rows.join(marked, rows["doc_id"].eqNullSafe(marked[f"{OWN}d"]) & (rows[f"{OWN}key"] == marked[f"{OWN}h"]), "left")
    text = F.col("text")
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(f"{OWN}m", first, lambda acc, x: F.when(x.e <= acc.at, acc).otherwise(F.struct(
        x.e.alias("at"), F.concat(acc.out, F.substring(text, acc.at + 1, F.greatest(F.lit(0), x.s - acc.at)),
                                  F.when(x.s >= acc.at, x.r).otherwise(F.lit(""))).alias("out"))),
        lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))))
    clean = F.when(F.col(f"{OWN}m").isNull(), text).otherwise(done)
    return rows.select(*[clean.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans_of(documents(spark, sf_dir))
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    base = F.transform("spans", lambda x: F.concat_ws(":", name(x.k), x.s.cast("string"), x.e.cast("string")))
    more = F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x.s.cast("string"), x.e.cast("string")))
    count = lambda i: F.size(F.filter("spans", lambda x: x.k == i)).cast("long")
    return rows.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                       F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                       F.array_join(F.concat(base, more), ",").alias("spans"), F.size("terms").cast("long").alias("n_terms"))
