"""Dictionary matching in free text.

Terms and texts are compared in one form: NFKC, blanks collapsed, lower case.
Running text is read once: at every place where a term may begin, a tree of all
terms is walked as far as the text goes along with it. The stretches found are
then dealt to terms, longest term first.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# What surrounds a tag without being part of it; the edges of a
# term in running text (``C++``, ``.NET`` and ``Node.js`` are terms); and short
# terms that only count as a whole tag.
LEAD = r"^(?:[\s\-–—*•·+>\d)\]]+|\.(?![A-Za-z]))+"
TRAIL = r"[\s:;,.…]+$"
LEFT = r"(?<![A-Za-z0-9+#])(?<!\w\.)"
RIGHT = r"(?![A-Za-z0-9+#])(?!\.\w)"
EXACT_ONLY = ["c", "go", "r", "ml", "bi", "cv", "js", "ts", "py", "k8", "sap", "erp", "crm"]

_AROUND = re.compile(f"{LEAD}|{TRAIL}")


@F.pandas_udf(StringType())
def _fold(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def nfkc(text: Column) -> Column:
    """NFKC form; newlines and case are kept."""
    return _fold(text)


def normalise_value(tag: str | None) -> str:
    """The same for one Python value, as rule tables are loaded on the driver."""
    words = unicodedata.normalize("NFKC", tag or "").split()
    return _AROUND.sub("", " ".join(words)).casefold().strip()


@F.pandas_udf(StringType())
def _normalise(tag: pd.Series) -> pd.Series:
    return tag.map(normalise_value)


def normalise(tag: Column) -> Column:
    """A tag without blanks, decoration and case; '' for null. One Arrow hop:
    NFKC and case folding have no built-in."""
    return _normalise(tag)


def scannable(term: str) -> bool:
    """Whether a normalised term may be searched in running text."""
    return term not in EXACT_ONLY and (len(term) >= 3 or any(c in term for c in "+#."))


@dataclass
class Vocabulary:
    """Canonical names with their aliases, and terms that are never skills.

    ``names``: kind -> {canonical: aliases}. The first owner of a term keeps it."""

    names: dict[str, dict[str, list[str]]]
    excluded: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        listed = [(kind, name, aliases or []) for kind, table in self.names.items() for name, aliases in table.items()]
        owned = [(normalise_value(term), name) for _, name, aliases in listed for term in [name, *aliases]]
        # later owners are overwritten by earlier ones; the order stays as listed
        first = dict(reversed(owned))
        self.lookup: dict[str, str] = {term: first[term] for term, _ in owned if term}
        self.kinds: dict[str, str] = {name: kind for kind, name, _ in reversed(listed)}
        self.dropped = {normalise_value(x) for x in self.excluded}
        self.tags = {term: name for term, name in self.lookup.items() if term not in self.dropped}

    def exact(self, tag: str | None) -> str | None:
        return self.tags.get(normalise_value(tag))

    def kind(self, canonical: str) -> str:
        return self.kinds[canonical]

    def scan_order(self) -> list[tuple[str, str]]:
        """(term, canonical) that may be scanned, longest first, else as listed."""
        return sorted(((t, c) for t, c in self.lookup.items() if scannable(t)), key=lambda x: -len(x[0]))

    def terms(self) -> list[tuple[str, str, bool]]:
        """(term, canonical, scannable), by term: the exported lookup."""
        return sorted((t, c, scannable(t)) for t, c in self.lookup.items())

    # columns ---------------------------------------------------------------

    def exact_column(self, tag: Column) -> Column:
        """Canonical name of one tag, or null: a literal map, no join."""
        pairs = [F.lit(x) for pair in self.tags.items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), normalise(tag)) if pairs else F.lit(None).cast("string")

    def extract_column(self, tags: Column, description: Column, bullets: Column) -> Column:
        """Ordered set of canonical names: tags first, then running text."""
        return _extractor(self)(tags, description, bullets)


class Scanner:
    """Finds terms in running text. Of stretches that overlap the longest term's
    counts; a term takes its first free stretch, and only that one."""

    def __init__(self, vocabulary: Vocabulary):
        self.exact = vocabulary.tags
        self.names = [name for _, name in vocabulary.scan_order()]
        self.tree: dict = {}  # character -> subtree; "" -> the term's place in the order
        for place, (term, _) in enumerate(vocabulary.scan_order()):
            node = self.tree
            for c in term:
                node = node.setdefault(c, {})
            node.setdefault("", place)
        heads = "".join(map(re.escape, sorted(self.tree)))
        self.begin = re.compile(f"{LEFT}(?=[{heads}])") if heads else None
        self.end = re.compile(RIGHT)

    def stretches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(term's place, start, end) of every occurrence between its edges."""
        for m in self.begin.finditer(text) if self.begin else ():
            node, at = self.tree, m.start()
            while at < len(text) and (node := node.get(text[at])) is not None:
                at += 1
                if "" in node and self.end.match(text, at):
                    yield node[""], m.start(), at

    def scan(self, text: str) -> list[str]:
        said = unicodedata.normalize("NFKC", text).lower()
        found: dict[int, str] = {}
        free = bytearray(b"\1") * len(said)
        for place, a, b in sorted(self.stretches(said)):
            if place not in found and 0 not in free[a:b]:
                found[place] = self.names[place]
                free[a:b] = bytes(b - a)
        return list(dict.fromkeys(found.values()))

    def extract(self, tags: Iterable[str] | None, description: str | None, bullets: Iterable[str] | None) -> list[str]:
        tagged = [self.exact.get(normalise_value(t)) for t in ([] if tags is None else tags)]
        said = "\n".join(str(p) for p in [description, *([] if bullets is None else bullets)] if p)
        return list(dict.fromkeys([name for name in tagged if name] + self.scan(said)))


def _extractor(vocabulary: Vocabulary):
    held: list[Scanner] = []

    @F.pandas_udf(ArrayType(StringType()))
    def extract(tags: pd.Series, description: pd.Series, bullets: pd.Series) -> pd.Series:
        if not held:
            held.append(Scanner(vocabulary))
        return pd.Series([held[0].extract(*row) for row in zip(tags, description, bullets, strict=True)])

    return extract


#: A whole run of the characters that edges are made of.
_RUN = "[A-Za-z0-9+#]+"


def plain_terms(text: Column, vocabulary: Vocabulary) -> Column:
    """Sorted canonical names whose terms stand in ``text``, without a UDF. Equal
    to the scanner where no term lies inside another. The text's runs between
    edges are cut out once and looked up together; only terms that are no such
    run (blanks, dots, accents) are searched one by one."""
    runs: dict[str, str] = {}
    others: dict[str, list[str]] = {}
    for term, name in vocabulary.scan_order():
        if re.fullmatch(_RUN, term):
            runs[term] = name
        else:
            others.setdefault(name, []).append(term)
    none = F.array().cast("array<string>")
    found = none
    if runs:
        whole = F.regexp_extract_all(text, F.lit(f"(?U){LEFT}{_RUN}{RIGHT}"), F.lit(0))
        table = F.create_map(*[F.lit(x) for pair in runs.items() for x in pair])
        known = F.array_intersect(F.transform(whole, F.lower), F.array(*map(F.lit, runs)))
        found = F.transform(known, lambda t: F.element_at(table, t))
    searched = [
        F.when(text.rlike(f"(?iuU){LEFT}(?:{'|'.join(r'\Q' + t + r'\E' for t in terms)}){RIGHT}"), F.lit(name)) for name, terms in others.items()
    ]
    rest = F.filter(F.array(*searched), lambda x: x.isNotNull()) if searched else none
    return F.coalesce(F.array_sort(F.array_union(found, rest)), none)


def load_vocabulary(path: str | None = None) -> Vocabulary:
    """A vocabulary from YAML: kinds with their names, and ``excluded``."""
    from pathlib import Path

    import yaml

    where = Path(path) if path else Path(__file__).parent.parent / "rules" / "vocabulary.yaml"
    doc = yaml.safe_load(where.read_text(encoding="utf-8"))
    excluded = doc.pop("excluded", [])
    return Vocabulary({kind: {str(k): v for k, v in names.items()} for kind, names in doc.items()}, excluded)
