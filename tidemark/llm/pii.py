"""Personal data: pattern spans, and terms that disclose them.

Pattern spans (email, ip, card, phone) come from built-in regular expressions;
offsets from the lengths of what lies between matches. Each pattern match is a
protected entity. A term (a word of letters and digits) in a document with an
entity, not only inside the entity's one occurrence there, is scored by how much
of the entity's information it gives away, from counts over all documents:

    PMI(term; entity) / IC(entity) = 1 + ln p(entity | term) / -ln p(entity)

Terms with a ratio of at least ``DISCLOSURE`` that stand with the entity in at
least ``SUPPORT`` documents are spans too, wherever they occur in a document;
``sanitise`` replaces entities and disclosing terms by their kind.

A secret discloses itself: a run of at least ``KEY`` letters and digits that is
given to a name (``=`` or ``:``) and whose characters carry at least
``SECRET_BITS`` bits each, by their own frequencies, is a span of kind secret.

Counting is pre-aggregated: copies of a text are one row with a weight, and an
entity meets only the terms that can reach support and ratio at
n_te <= min(n_e, n_t), which loses none. Terms that cannot reach the ratio even
if they occurred in no other document are dropped before the corpus is scanned
for them. Text is joined only where a document holds a disclosing term. Offsets
are summed within runs of ``RUN`` matches and then over the runs, so the work
grows with the matches of a text, not with their square.

Cases: null or empty text has no spans; equal spans of two kinds both stay;
rows of one id and text are one document to the counts, and all returned; a
null doc_id is carried; an empty table gives an empty result; other columns
are ignored (``sanitise`` carries them, whatever their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, let, named, sieve, table, text_of
from tidemark.session import materialize

QUERY = "op8_pii"
KINDS = ["email", "ip", "card", "phone", "term", "secret"]
SUPPORT, DISCLOSURE = 2, 0.95
KEY, SECRET_BITS, RUN = 16, 3.0, 256

#: Candidate rows up to which a side is broadcast; a shuffle join beyond.
SMALL = 200_000

#: Possessive and anchored at the start of a run (or where the last match
#: ended), so that a failing run is read once; they match what the plain forms
#: match, as no class is followed by one of its own characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRET = rf"(?<=[=:][\"'\x20]{{1,2}}|[=:])[A-Za-z0-9+/_-]{{{KEY},}}+"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
TERM = r"\p{L}[\p{L}\p{N}]*+"
_OPEN_TERM = r"(?<![\p{L}\p{N}])\p{N}*+\p{L}[\p{L}\p{N}]*+$"
SPAN = "struct<start:long,kind:int,end:long,text:string>"


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return let(digits, lambda d: F.when(F.char_length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def _test(kind: str):
    return lambda span: _valid(kind, span["text"])


def _located(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array<SPAN> of all matches (that ``keep`` holds for): offsets in code
    points, end exclusive."""
    none = F.array().cast(f"array<{SPAN}>")

    def run(pairs: Column) -> Column:
        """(spans, length) of a run, from its own start; the array that grows is short."""
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

        def step(acc: Column, pair: Column) -> Column:
            first = acc["at"] + F.char_length(pair["gap"])
            last = first + F.char_length(pair["text"])
            span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), last.alias("end"), pair["text"].alias("text"))
            spans = F.array_append(acc["spans"], span).cast(f"array<{SPAN}>")
            if keep:
                spans = F.when(keep(pair["text"]), spans).otherwise(acc["spans"])
            return F.struct(last.alias("at"), spans.alias("spans"))

        return F.aggregate(pairs, start, step)

    def place(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        pairs = F.zip_with(
            F.slice(between, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("text"))
        )
        firsts = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / RUN).cast("int"))

        def cut(all_pairs: Column) -> Column:
            return F.transform(firsts, lambda k: run(F.slice(all_pairs, k * RUN + 1, RUN)))

        def moved(runs: Column) -> Column:
            start = F.array(F.lit(0).cast("long"))
            offsets = F.aggregate(runs, start, lambda acc, r: F.array_append(acc, F.element_at(acc, -1) + r["at"]))
            return let(
                offsets,
                lambda at: F.flatten(
                    F.transform(
                        runs,
                        lambda r, k: F.transform(
                            r["spans"],
                            lambda x: F.struct(
                                (x["start"] + F.get(at, k)).alias("start"), x["kind"].alias("kind"), (x["end"] + F.get(at, k)).alias("end"), x["text"].alias("text")
                            ),
                        ),
                    )
                ),
            )

        return F.when(F.size(found) == 0, none).otherwise(let(let(pairs, cut), moved))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def _bits(text: Column) -> Column:
    """Bits a character, by the text's own frequencies."""
    letters = F.split(text, "")

    def entropy(chars: Column) -> Column:
        n = F.size(chars).cast("double")
        return F.aggregate(
            F.array_distinct(chars),
            F.lit(0.0),
            lambda total, c: let(F.size(F.filter(chars, lambda x: x == c)) / n, lambda p: total - p * F.log2(p)),
        )

    return let(F.filter(letters, lambda c: c != ""), entropy)


def secret_spans(text: Column) -> Column:
    """array<SPAN> of values given to a name that look like keys."""
    found = _located(text, SECRET, KINDS.index("secret"))
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]")
    found = F.filter(found, lambda s: mixed(s["text"]) & (_bits(s["text"]) >= SECRET_BITS))
    return F.when(text.rlike("[=:]"), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def pattern_spans(text: Column) -> Column:
    """array<SPAN> of all valid pattern matches, by start and kind."""
    each = []
    for kind, name in enumerate(KINDS[:4]):
        spans = F.filter(_located(text, PATTERNS[name], kind), _test(name))
        sign = {"email": "@", "phone": "+"}.get(name)
        if sign:
            spans = F.when(F.contains(text, F.lit(sign)), spans).otherwise(F.array().cast(f"array<{SPAN}>"))
        each.append(spans)
    return F.sort_array(F.concat(*each))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _own(text: Column, span: Column) -> Column:
    """The terms of ``text`` that lie inside a span, repeats included. A term
    that goes on before or after the span is not one of them."""
    def inside(own: Column) -> Column:
        before = F.lower(F.substr(text, span["start"].cast("int"), F.lit(1)))
        opened = (
            (span["start"] > 0)
            & F.lower(span["text"]).rlike(r"^\p{N}*+\p{L}")
            & before.rlike(r"[\p{L}\p{N}]$")
            & F.lower(F.substr(text, F.lit(1), span["start"].cast("int"))).rlike(_OPEN_TERM)
        )
        after = F.lower(F.substr(text, (span["end"] + 1).cast("int"), F.lit(1)))
        goes_on = F.lower(span["text"]).rlike(_OPEN_TERM) & after.rlike(r"^[\p{L}\p{N}]")
        first = F.when(opened, 2).otherwise(1)
        last = F.size(own) - F.when(goes_on, 1).otherwise(0)
        return F.when(last < first, F.array().cast("array<string>")).otherwise(F.slice(own, first, last - first + 1))

    return let(_terms(span["text"]), lambda own: F.when(F.size(own) == 0, own).otherwise(inside(own)))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, base, secrets, context): a row for each row of ``docs``."""
    text = text_of()
    found = docs.select(
        F.col("doc_id").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"), pattern_spans(text).alias("base"), secret_spans(text).alias("secrets")
    )
    context = F.transform(
        "base",
        lambda s: F.struct(
            F.concat(s["kind"].cast("string"), F.lit(":"), F.lower(s["text"])).alias("entity"),
            _own(F.col("text"), s).alias("own"),
        ),
    )
    return found.select("doc_id", "th", "base", "secrets", context.alias("context"))


def _near(left: DataFrame, right: DataFrame, on, weight: Column | None = None) -> DataFrame:
    """Inner join; ``right`` is broadcast when its counted size allows (rows, or
    what ``weight`` counts in them)."""
    size = right.agg(F.coalesce(F.sum(F.lit(1) if weight is None else weight), F.lit(0))).first()[0]
    return left.join(F.broadcast(right) if size <= SMALL else right, on)


def disclosing_terms(docs: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, ratio) of the disclosing terms, and (doc_id, th, terms) of the
    documents that hold them."""
    known = base.select("doc_id", "th").distinct().count()
    copies = base.filter(F.size("context") > 0).groupBy("th", "doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.first("context").alias("context")
    )
    copies = copies.groupBy("th").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("docs"), F.first("context").alias("context")
    )
    stands = (
        copies.select("th", "rows", "docs", F.explode("context").alias("c"))
        .groupBy("th", F.col("c.entity").alias("entity"))
        .agg(
            F.first("rows").alias("rows"), F.first("docs").alias("docs"),
            F.count(F.lit(1)).alias("times"), F.first("c.own").alias("own"),
        )
    )
    stands = materialize(stands, "op8-stands")
    information = -F.log(F.col("n_e") / F.lit(max(known, 1)))

    def ratio(of: str) -> Column:
        return F.when(information > 0, 1 + F.log(F.col("n_te") / F.col(of)) / information).otherwise(F.lit(0.0))

    # n_te <= min(n_e, n_t): an entity needs SUPPORT documents, a term at most ``cap``
    cap = F.col("n_e") * F.exp((1 - DISCLOSURE) * information) * (1 + 1e-9)
    entities = (
        stands.groupBy("entity").agg(F.sum("docs").alias("n_e"))
        .filter((F.col("n_e") >= SUPPORT) & (F.col("n_e") < known)).withColumn("cap", cap)
    )
    repeated = materialize(stands.join(entities, "entity"), "op8-repeated")
    texts = repeated.groupBy("th").agg(F.first("rows").alias("rows"), F.first("docs").alias("docs"), F.max("cap").alias("most"))
    texts = materialize(texts, "op8-texts")
    text = text_of()
    words = (
        _near(docs.select(F.xxhash64(text).alias("th"), text.alias("text")), texts, "th")
        .select("th", "rows", "docs", "most", F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("th", "term")
        .agg(F.count(F.lit(1)).alias("all"), *[F.first(c).alias(c) for c in ("rows", "docs", "most")])
        .select("th", "term", "docs", "most", (F.col("all") / F.col("rows")).alias("all"))
    )
    words = materialize(words, "op8-words")
    seen = words.groupBy("term").agg(F.sum("docs").alias("n_near"), F.max("most").alias("top"))
    seen = seen.filter((F.col("n_near") >= SUPPORT) & (F.col("n_near") <= F.col("top"))).drop("top")
    rare = words.join(seen, "term").filter(F.col("n_near") <= F.col("most")).select("th", "term", "all", "n_near")
    inside = (F.col("times") == 1) & (F.size(F.filter("own", lambda t: t == F.col("term"))) == F.col("all"))
    pairs = (
        repeated.join(rare, "th").filter((F.col("n_near") <= F.col("cap")) & ~inside)
        .groupBy("entity", "term")
        .agg(F.sum("docs").alias("n_te"), F.first("n_e").alias("n_e"), F.first("n_near").alias("n_near"))
        .filter(F.col("n_te") >= SUPPORT)
    )
    scored = pairs.filter(ratio("n_near") >= DISCLOSURE)
    scored = materialize(scored, "op8-scored")
    wanted = scored.select("term").distinct()
    held = _near(
        docs.select("doc_id", F.xxhash64(text).alias("th"), F.explode(F.array_distinct(_terms(text))).alias("term")), wanted, "term"
    )
    held = materialize(held.distinct(), "op8-held")
    in_all = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    terms = (
        scored.join(in_all, "term").filter(ratio("n_t") >= DISCLOSURE).groupBy("term").agg(F.max(ratio("n_t")).alias("ratio"))
    )
    terms = materialize(terms, "op8-terms")
    holders = _near(held, terms, "term").groupBy("doc_id", "th").agg(F.collect_set("term").alias("terms"))
    return terms, materialize(holders, "op8-holders")


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, base, more): pattern spans, and the method's: terms and secrets."""
    base = materialize(base_spans(docs), "op8-base")
    _, holders = disclosing_terms(docs, base)
    text = text_of()
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th")).alias("d")
    holders = holders.select(F.col("doc_id").alias("h_id"), F.col("th").alias("h_th"), F.col("terms").alias("held"))
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("th") == F.col("h_th"))
    term = _located(F.col("text"), TERM, 4, lambda t: F.array_contains(F.col("held"), F.lower(t)))
    placed = _near(texts, holders, same, F.size("held") + 1).select("h_id", "h_th", term.alias("terms")).distinct()
    placed = materialize(placed, "op8-placed")
    none = F.array().cast(f"array<{SPAN}>")
    more = F.concat(F.coalesce("terms", none), F.coalesce("secrets", none))
    return base.join(placed, same, "left").select("doc_id", "th", "base", more.alias("more"))


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities, secrets and disclosing terms replaced by their kind
    in ``text``; overlapping spans become one, named after the first. ``n_chars``
    follows. Other columns stay; a null text stays null."""
    text, own, key = text_of(), fresh("__found", docs), fresh("__key", docs)
    found = spans(docs).select("doc_id", "th", F.sort_array(F.concat("base", "more")).alias("spans"))
    found = found.filter(F.size("spans") > 0).distinct().select(F.struct("doc_id", "th", "spans").alias(own))
    found = materialize(found, "op8-found")
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    held = F.col(own)["spans"]

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        piece = F.when(s["start"] >= acc["at"], F.concat(gap, F.get(kinds, s["kind"]))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.array_append(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    tail = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, (acc["at"] + 1).cast("int"), F.lit(1 << 30)))
    clean = F.aggregate(held, start, step, tail)
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("th")))
    same = named(key)["doc_id"].eqNullSafe(F.col(own)["doc_id"]) & (named(key)["th"] == F.col(own)["th"])
    hit = F.col(own).isNotNull() & F.col("text").isNotNull()
    done = F.struct(F.when(hit, clean).otherwise(F.col("text")).alias("text"), hit.alias("hit")).alias(key)
    hashed = lambda k: F.xxhash64(F.lit(2), k["doc_id"], k["th"])
    marked, clear = sieve(keyed, hashed(named(key)), found.select(hashed(F.col(own)).alias("h")))
    out = marked.join(found, same, "left").unionByName(clear, allowMissingColumns=True).select(*map(named, docs.columns), done)
    columns = {c: named(c) for c in docs.columns} | {"text": named(key)["text"]}
    if "n_chars" in columns:
        length = F.char_length(named(key)["text"]).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(named(key)["hit"], length).otherwise(F.col("n_chars"))
    return out.select(*[c.alias(n) for n, c in columns.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.sort_array(F.concat("base", "more"))).alias("spans"),
        # personal data or a secret of its own, not only a word that points to another's
        ((F.size("base") > 0) | F.exists("more", lambda s: s["kind"] == KINDS.index("secret"))).alias("private"),
    )


ORACLE_SQL = None
