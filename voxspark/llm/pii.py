r"""Personal data: pattern spans, and terms that disclose them by corpus co-occurrence.

Base spans are e-mail addresses, IP addresses, card and phone numbers, leftmost and not
overlapping per kind.  A protected entity is a distinct value of one kind.  A term (word of
three letters or more) within ``reach`` characters of an entity may reveal it: with
document counts over the whole corpus, p(c|t) = n(t, c) / n(t) and p(c) = n(c) / N, the term
discloses the share PMI / IC = 1 - log p(c|t) / log p(c) of the entity's information.  Terms
that disclose ``alpha`` or more and stand with the entity in ``support`` different contexts
(copies of one context count once) are spans too.  Spans are generalised to the name of
their kind, or removed.

All of it is column expressions, joins and aggregates.  Positions follow from the lengths
of the matches and of the gaps between them.  Only the few rows with spans are written and
counted further; of the other texts only the words are counted, against the candidate
terms (a broadcast if their number is below a bound, else a shuffle join).

Defined results: null text counts as empty; repeated rows give equal spans and count as
separate documents; an empty table gives no rows; a null id is an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, written

ALPHA, SUPPORT, REACH = 0.75, 3, 40
BROADCAST_TERMS = 100_000
BROADCAST_SPANS = 1_000_000     # spans and rows, at most 48 bytes each
STEP, LEVELS = 64, 3            # entries a block, and levels of blocks, of running()
PIECE = 1024                    # code points a piece of a cut text

# The kinds in order, with the text that a match needs and its pattern.  The quantifiers are
# possessive where nothing can be given back, so long runs cost neither time nor stack.
KINDS = ("email", "ip", "card", "phone")
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TERM = r"\p{L}{3,}+"
_MARK = "\uffff"                              # a noncharacter: overwrites base spans, ends no word
_FREE_TERM = r"[\p{L}\x{FFFF}]{3,}+"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    r = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + F.when(
        i % 2 == 1, F.substr(r, i, F.lit(1)).cast("int")).otherwise(
            F.substr(r, i, F.lit(1)).cast("int") * 2 - F.when(F.substr(r, i, F.lit(1)) > "4", 9).otherwise(0)))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.when(
            F.length(F.ltrim(p, F.lit("0"))) <= 3, F.right(p, F.lit(3)).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(m))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, merge, levels: int = LEVELS) -> Column:
    """Before each entry of an int array, all earlier ones merged (an associative function, 0 for none).
    Blocks of STEP entries are merged first and run over by the same rule, so an entry costs at most
    STEP steps a level, however many there are."""
    def all_of(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), merge)

    def run(v: Column) -> Column:
        if not levels:
            return F.transform(v, lambda _, i: all_of(F.slice(v, F.lit(1), i)))
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / STEP).cast("int")), lambda j: all_of(F.slice(v, j * STEP + 1, F.lit(STEP))))
        return _let(running(blocks, merge, levels - 1), lambda high: F.transform(v, lambda _, i: merge(
            F.get(high, F.floor(i / STEP).cast("int")), all_of(F.slice(v, i - i % STEP + 1, i % STEP)))))
    return _let(values, run)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _cut(text: Column) -> Column:
    """The text in pieces of PIECE code points: a substring of a long text is counted from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{PIECE}}})"), F.lit(1))


def _part(pieces: Column, start: Column, n: Column) -> Column:
    """``n`` code points of a cut text from ``start`` (0 for the first)."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(pieces, first + 1, F.floor((start + n) / PIECE).cast("int") - first + 1)
    return F.substr(F.array_join(some, ""), start % PIECE + 1, n)


def matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern as spans: start and end in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    both = F.zip_with(found, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda m, g: F.struct(
        m.alias("value"), F.length(g).alias("gap"), F.length(m).alias("n")))

    def spans(x: Column) -> Column:
        return F.zip_with(x, running(F.transform(x, lambda w: w["gap"] + w["n"]), _plus), lambda w, at: F.struct(
            (at + w["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + w["gap"] + w["n"]).alias("end"), w["value"].alias("value")))

    return F.when(text.rlike(pattern), _let(both, spans)).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """The valid spans of all kinds, by start, then kind."""
    parts = []
    for i, k in enumerate(KINDS):
        got = F.filter(matches(text, _PATTERN[k], i), _checker(k))
        if _NEEDS[k]:
            got = F.when(F.contains(text, F.lit(_NEEDS[k])), got).otherwise(F.array().cast(SPAN))
        parts.append(got)
    return F.array_sort(F.concat(*parts))


def _checker(kind: str):
    return lambda s: _valid(kind, s["value"])


def _entity(s: Column) -> Column:
    return F.concat(s["kind"].cast("string"), F.lit(":"),
                    F.when(s["kind"] >= 2, _digits(s["value"])).otherwise(F.lower(s["value"])))


def _context(text: Column, spans: Column, free: Column, reach: int) -> Column:
    """For every span its entity and the terms whole inside ``reach`` characters either side that no
    span overlaps; ``free`` is the masked text."""
    def one(x: Column, s: Column) -> Column:
        lo = F.greatest(F.lit(0), s["start"] - reach)
        hi = F.least(x["n"], s["end"] + reach)
        left, right = _part(x["text"], lo, s["start"] - lo), _part(x["text"], s["end"], hi - s["end"])

        def terms(part: Column, masked: Column, at: Column, cut) -> Column:
            some = F.filter(matches(part, _TERM, len(KINDS)), lambda t: cut(t) & ~F.contains(
                F.substr(masked, t["start"] + 1, t["end"] - t["start"]), F.lit(_MARK)))
            return F.transform(some, lambda t: F.struct(
                F.lower(t["value"]).alias("term"), (t["start"] + at).alias("start"), (t["end"] + at).alias("end")))

        both = F.concat(
            terms(left, _part(x["free"], lo, s["start"] - lo), lo, lambda t: (t["start"] > 0) | (lo == 0)),
            terms(right, _part(x["free"], s["end"], hi - s["end"]), s["end"], lambda t: (t["end"] < F.length(right)) | (hi == x["n"])))
        return F.struct(_entity(s).alias("entity"), F.xxhash64(left, right).alias("place"), both.alias("terms"))
    whole = F.struct(_cut(text).alias("text"), _cut(free).alias("free"), F.length(text).alias("n"), spans.alias("spans"))
    return _let(whole, lambda x: F.transform(x["spans"], lambda s: one(x, s)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _rewritten(text: Column, spans: Column, piece) -> Column:
    """The text with ``piece(text before, span, end of all spans before)`` for every span, and the rest."""
    def run(x: Column) -> Column:
        ends = F.transform(x["spans"], lambda s: s["end"])
        parts = F.zip_with(x["spans"], running(ends, _later), lambda s, at: piece(
            _part(x["text"], at, F.greatest(F.lit(0), s["start"] - at)), s, at))
        rest = _let(F.aggregate(ends, F.lit(0), _later), lambda at: _part(x["text"], at, F.greatest(F.lit(0), x["n"] - at)))
        return F.concat(F.array_join(parts, ""), rest)
    return _let(F.struct(_cut(text).alias("text"), F.length(text).alias("n"), spans.alias("spans")), run)


def _masked(text: Column, spans: Column) -> Column:
    """The text with every base span overwritten by ``_MARK``, so that positions stay."""
    return _rewritten(text, spans, lambda before, s, at: F.concat(
        before, F.repeat(F.lit(_MARK), F.greatest(F.lit(0), s["end"] - F.greatest(at, s["start"])))))


def _words(text: Column, pattern: str = _TERM) -> Column:
    """The distinct terms of a text; none that touches a masked span."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    if pattern != _TERM:
        found = F.filter(found, lambda w: ~F.contains(w, F.lit(_MARK)))
    return F.array_distinct(F.transform(found, lambda w: F.lower(w)))


def disclosing_terms(docs: DataFrame, held: DataFrame, total: int, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``(entity, term)`` pairs over the disclosure threshold.  ``held``: the rows with base spans
    (row, copy, entities, contexts, words, inside); ``total``: number of documents."""
    def share(n_both: Column, n_term: Column, n_entity: Column) -> Column:
        return 1 - F.log(F.least(F.lit(1.0), n_both / n_term)) / F.log(n_entity / F.lit(total))

    ctx = held.select(F.explode("contexts").alias("c")).select("c.entity", "c.place", F.explode("c.terms").alias("t"))
    near = written(ctx.groupBy("entity", F.col("t.term").alias("term")).agg(F.count_distinct("place").alias("n_places"))
                   .where(F.col("n_places") >= support), "near")
    n_entity = held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    live = (n_entity.where(F.col("n_entity") < total).join(near.groupBy("entity").agg(F.count("*").alias("near")), "entity", "left")
            .where((F.col("n_entity") >= support) | F.col("near").isNotNull()).select("n_entity", "entity"))
    ents = (held.select("row", F.explode("entities").alias("entity")).join(live, "entity")
            .groupBy("row").agg(F.collect_list(F.struct("n_entity", "entity")).alias("ents")))
    rows = written(held.select("row", "copy", "words").join(ents, "row"), "held")
    terms = written(rows.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
                    .where(F.col("n") >= support).select("term").union(near.select("term")).distinct(), "terms")
    n_terms = terms.count()

    def sized(df: DataFrame) -> DataFrame:          # checked size; else the join shuffles words
        return F.broadcast(df) if n_terms <= BROADCAST_TERMS else df

    # a word that stands in a base span only does not count as a term of that document
    words = docs.select(F.explode(_words(F.col("text"))).alias("term"), F.lit(1).alias("n")).union(
        held.select(F.explode("inside"), F.lit(-1)))
    n_term = written(words.join(sized(terms), "term").groupBy("term").agg(F.sum("n").alias("n_term")).where("n_term > 0"), "counts")
    can = lambda e: share(F.least(F.col("n_term"), e["n_entity"]), F.col("n_term"), e["n_entity"]) >= alpha - 1e-9
    pairs = (rows.select("copy", "ents", F.explode("words").alias("term")).join(sized(n_term), "term")
             .select("copy", "term", "n_term", F.explode(F.filter("ents", can)).alias("e"))
             .groupBy("term", "n_term", F.col("e.entity").alias("entity"), F.col("e.n_entity").alias("n_entity"))
             .agg(F.count("*").alias("n_both"), F.count_distinct("copy").alias("n_copies"))
             .where(share(F.col("n_both"), F.col("n_term"), F.col("n_entity")) >= alpha))
    return (pairs.join(near, ["entity", "term"], "left")
            .where((F.col("n_copies") >= support) | F.col("n_places").isNotNull()).select("entity", "term"))


def _places(held: DataFrame) -> DataFrame:
    """``row, term, start, end`` of every term outside the base spans.  Ends are running sums over a
    row's words, linear in their number."""
    free = F.col("free")
    found = F.regexp_extract_all(free, F.lit(f"({_FREE_TERM})"), F.lit(1))
    gaps = F.slice(F.split(free, _FREE_TERM, -1), F.lit(1), F.size(found))
    one = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("value"), (F.length(g) + F.length(m)).alias("n")))
    before = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (held.select("row", F.posexplode(one).alias("i", "w")).withColumn("end", F.sum("w.n").over(before).cast("int"))
            .where(~F.contains("w.value", F.lit(_MARK)))
            .select("row", F.lower("w.value").alias("term"), (F.col("end") - F.length("w.value")).alias("start"), "end"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, support: int = SUPPORT,
         reach: int = REACH) -> DataFrame:
    """One row per document: ``id``, ``key`` (hash of id and text), ``base`` and ``all`` spans by
    start, then kind (``len(KINDS)`` is a term)."""
    keyed = _keyed(docs, id_col, text_col)
    spans = keyed.withColumn("base", base_spans(F.col("text")))
    some = F.size("base") > 0
    spans = spans.withColumn("free", F.when(some, _masked(F.col("text"), F.col("base"))))
    base = written(spans.select(
        F.monotonically_increasing_id().alias("row"), "id", "key", "base", F.xxhash64("text").alias("copy"),
        F.when(some, _context(F.col("text"), F.col("base"), F.col("free"), reach)).alias("contexts"),
        F.when(some, _words(F.col("text"))).alias("all_words"), "free"), "spans")
    held = (base.where(some).withColumn("words", _words(F.col("free"), _FREE_TERM))
            .withColumn("inside", F.array_except("all_words", "words"))
            .withColumn("entities", F.array_distinct(F.transform("contexts", lambda c: c["entity"]))))
    pairs = disclosing_terms(keyed, held, base.count(), alpha, support)
    reveal = written(held.select("row", F.explode("entities").alias("entity")).join(pairs, "entity").select("row", "term").distinct(), "reveal")
    marked = held.select("row", "free").join(reveal.select("row").distinct(), "row", "left_semi")
    extra = (_places(marked).join(reveal, ["row", "term"]).select("row", F.struct(
        "start", F.lit(len(KINDS)).alias("kind"), "end", F.col("term").alias("value")).alias("s"))
        .groupBy("row").agg(F.collect_list("s").alias("extra")))
    return base.select("row", "id", "key", "base").join(extra, "row", "left").select(
        "id", "key", "base", F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(SPAN)))).alias("all"))


def written_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Counts and digests per document."""
    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return find(docs, id_col, text_col, **params).select(
        F.col("id").alias(id_col), *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(written_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"), written_spans(F.col("all")).alias("spans"))


def sanitised(text: Column, spans: Column, remove: bool = False) -> Column:
    """The text with every span generalised to ``[KIND]`` or removed; of overlapping spans the
    first names the kind and both go."""
    names = F.array(*[F.lit("" if remove else f"[{k.upper()}]") for k in (*KINDS, "term")])
    return _rewritten(text, spans, lambda before, s, at: F.when(
        s["start"] >= at, F.concat(before, F.get(names, s["kind"]))).otherwise(F.lit("")))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: bool = False, **params) -> DataFrame:
    """``docs`` with its text sanitised, all columns kept, whatever their names.  Rows without spans are not moved."""
    found = find(docs, id_col, text_col, **params).where(F.size("all") > 0)
    at, spans = free_names(docs, "key", "spans")
    places = F.transform("all", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    found = written(found.select(F.col("key").alias(at), places.alias(spans)).dropDuplicates([at]), "found")
    here = F.xxhash64(docs[id_col], docs[text_col])
    if (found.agg(F.sum(F.size(spans) + 1)).first()[0] or 0) <= BROADCAST_SPANS:    # checked size; else the join shuffles
        found = F.broadcast(found)
    marked = docs.join(found, here == F.col(at), "left")
    text = F.when(F.col(spans).isNotNull(), sanitised(F.coalesce(docs[text_col], F.lit("")), F.col(spans), remove)) \
        .otherwise(docs[text_col])
    return marked.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])
