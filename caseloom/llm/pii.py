"""Personal data in texts, also where it is written in disguise.

Method: a text is searched as it stands, and once more after transducers have rewritten it
to plain characters: look-alike letters and digits of other alphabets, letters that pass
for digits within a number, characters without width, digits spelled as words, and ``at`` / ``dot`` disguises. Each transducer keeps, for
every character it writes, the source characters it stands for, so a span found in the
rewritten text is mapped back to the source. Spans of the plain search always stay; one of
the second search is added unless it is equal to or inside a plain one of its kind, so an
address or number that is disguised in part has its plain part and the whole.

Kinds, each leftmost and without overlaps: e-mail address, IP address (four parts of at
most 255), payment card (12 to 19 digits that pass the Luhn check) and phone number (a
plus sign and 9 to 15 digits). A match that fails its check is dropped.

Scale: one pass over the rows without a shuffle; work and memory are linear in the length
of a text, however it is made up (no pattern looks at a character more than a fixed number
of times).

Defined cases: a null text is an empty one and has no spans; repeated rows get one result
row each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from caseloom.llm.arrow import map_batches

#: In this order spans with one start are listed (fixed value).
KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]

_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_not_digit = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    """Found from each @ sign: the run of name characters before it, the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _local:
            start -= 1
        if start < at and (domain := _domain.match(text, at + 1)):
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))
        # a run of name characters is walked back over once, as no two @ signs share one


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Spans of the text as it stands."""
    found = list(emails(text))
    if _digit.search(text):
        for m in _ip.finditer(text) if text.count(".") > 2 else ():
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _card.finditer(text):
            if m.end() - m.start() > 11:
                digits = _not_digit.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        for m in _phone.finditer(text) if "+" in text else ():
            if 9 <= len(_not_digit.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


#: Look-alikes of ASCII characters (fixed values): Cyrillic, Greek, and a few signs.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɡ": "g", "ⅼ": "l", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "−": "-", " ": " ", " ": " ", " ": " ", " ": " ",
}
#: Characters without width (fixed values).
NO_WIDTH = "­​‌‍⁠﻿"
#: Digits as words in the languages of the texts (fixed values).
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}


def _look_alike_table() -> dict[int, str]:
    table = {ord(a): b for a, b in LOOK_ALIKES.items()}
    table |= {0xFF00 + i: chr(0x20 + i) for i in range(1, 95)}  # full-width forms
    for zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        table |= {zero + i: str(i) for i in range(10)}
    return table


_table = _look_alike_table()
#: Letters that pass for digits within a number (fixed values).
DIGIT_LIKE = str.maketrans("OoIl", "0011")
_mixed = re.compile(r"[0-9][OoIl]|[OoIl][0-9]")
_numbers = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?:[ .-][0-9OoIl]++)*(?![A-Za-z0-9])")
_any_no_width = re.compile(f"[{NO_WIDTH}]+")
_word = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
#: At least three digit words or numbers, joined by single spaces, hyphens or a dot word.
_spelled = re.compile(rf"(?<!\w)(?:{_word}|[0-9]+)(?:(?:[ -]| dot )(?:{_word}|[0-9]+)){{2,}}(?!\w)", re.I)
_spelled_piece = re.compile(rf"{_word}|[0-9]+", re.I)
#: One that is an article too says nothing of a number nearby.
_telling = frozenset(DIGIT_WORDS) - {"un"}
_plus = re.compile(r"(?<!\w)plus (?=[0-9])", re.I)
_open, _close = r"\s?[(\[{<]\s?", r"\s?[)\]}>]\s?"
_at = re.compile(rf"(?:{_open}(?:at|@|arroba){_close}|&#0*64;|&commat;)", re.I)
_dot = re.compile(rf"(?:{_open}(?:dot|\.|punkt|point|punto){_close}|&#0*46;|&period;)", re.I)
#: Words without brackets count only in a whole address: name at host dot ending.
_name = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:(?:\.| dot )[A-Za-z0-9_%+-]++)*+", re.I)
_at_word = re.compile(r" at |@", re.I)
_host = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| dot )[A-Za-z0-9-]++)++", re.I)
_bracketed = re.compile(r"[(\[{<]\s?(?:at|@|arroba|dot|\.|punkt|point|punto)\s?[)\]}>]|&(?:#0*(?:46|64)|commat|period);", re.I)
#: No host is called so; what looks like an address around them is prose.
_articles = re.compile(r"(?: at |@)(?:the|a|an|this|that) dot ", re.I)
_number_dots = re.compile(r"(?<![0-9.])[0-9]++(?: ?dot ?[0-9]++){3}", re.I)
_plain_words = re.compile(r" at | ?dot ?", re.I)


class Rewriting:
    """A text under rewriting, with the source place of every character.

    ``starts[i]`` and ``ends[i]`` bound the source characters that character i stands for;
    None stands for the places of an unchanged text.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts: list[int] | None = None
        self.ends: list[int] | None = None

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Write other characters for pieces, given in order as (start, end, new).

        A written character stands for the whole piece it comes from.
        """
        if not edits:
            return
        if self.starts is None:
            self.starts = list(range(len(self.text)))
            self.ends = list(range(1, len(self.text) + 1))
        text, starts, ends, done = [], [], [], 0
        for start, end, new in edits:
            text += self.text[done:start], new
            starts += self.starts[done:start]
            ends += self.ends[done:start]
            if new:
                starts += [self.starts[start]] * len(new)
                ends += [self.ends[end - 1]] * len(new)
            done = end
        self.text = "".join([*text, self.text[done:]])
        self.starts = starts + self.starts[done:]
        self.ends = ends + self.ends[done:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (self.starts[start], self.ends[end - 1])


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Each word of a run becomes its digit; what joins it to the one before goes with it."""
    edits = []
    for run in _spelled.finditer(text):
        pieces = [p.span() for p in _spelled_piece.finditer(text, *run.span())]
        if all(text[a].isdigit() for a, _ in pieces):
            continue
        before = None
        for start, end in pieces:
            word = text[start:end].lower()
            if before == start - 1:
                edits.append((before, start, ""))
            if not word.isdigit():
                edits.append((start, end, DIGIT_WORDS[word]))
            before = end
    return edits


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Names of any number of parts, an at word, and hosts of two parts or more.

    A name is taken whole before what follows is looked at, so no place is read twice.
    """
    at = 0
    while name := _name.search(text, at):
        at = name.end()
        word = _at_word.match(text, at)
        host = _host.match(text, word.end()) if word else None
        if host:
            at = host.end()
            yield name.start(), at


def _address_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    numbers = [m.span() for m in _number_dots.finditer(text)]
    for found, named in ((_addresses(text), True), (numbers, False)):
        for start, end in found:
            inner = [w.span() for w in _plain_words.finditer(text, start, end)]
            words = [text[a:b].strip().lower() for a, b in inner]
            if named and ("dot" not in words or _articles.search(text, start, end)):
                continue
            edits += [(a, b, "@" if w == "at" else ".") for (a, b), w in zip(inner, words)]
    edits.sort()
    ends = [0, *accumulate((b for _, b, _ in edits), max)]
    return [e for e, before in zip(edits, ends) if e[0] >= before]


def normalise(text: str) -> Rewriting:
    """The text in plain characters, each tied to its source."""
    held = Rewriting(text)
    if _beyond_latin(text):
        held.text = text.translate(_table)  # one character for one
        held.replace([(*m.span(), "") for m in _any_no_width.finditer(held.text)])
    if _mixed.search(held.text):  # one character for one
        held.text = _numbers.sub(lambda m: m[0].translate(DIGIT_LIKE) if _digit.search(m[0]) else m[0], held.text)
    if not _telling.isdisjoint(held.text.lower().replace("-", " ").split()):
        held.replace(_spelled_edits(held.text))
        held.replace([(*m.span(), "+") for m in _plus.finditer(held.text)])
    if _bracketed.search(held.text):
        held.replace([(*m.span(), "@") for m in _at.finditer(held.text)])
        held.replace([(*m.span(), ".") for m in _dot.finditer(held.text)])
    if "dot" in held.text.lower():
        held.replace(_address_edits(held.text))
    return held


def _beyond_latin(text: str) -> bool:
    """Whether a character may be a look-alike or have no width."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return "\xa0" in text or "\xad" in text


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those of the rewritten text that reach beyond them; each by start, then kind."""
    base = plain_spans(text)
    held = normalise(text)
    added = []
    if held.text != text:
        taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        for kind, start, end in base:
            taken[kind].append((start, end))
        starts = {k: [start for start, _ in own] for k, own in taken.items()}
        for kind, start, end in plain_spans(held.text):
            start, end = held.source(start, end)
            # plain spans of a kind do not overlap: only the last to begin by then may hold it
            i = bisect_right(starts[kind], start) - 1
            if i < 0 or taken[kind][i][1] < end:
                added.append((kind, start, end))
    order = {k: i for i, k in enumerate(KINDS)}
    by = lambda s: (s[1], order[s[0]])
    return sorted(base, key=by), sorted(added, key=by)


def listed(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for kind, start, end in spans])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans``: arrays of (kind, start, end) in code points.

    ``base`` are the plain spans, ``spans`` those and the ones added.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            found = [all_spans(t or "") for t in batch.column(1).to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), s)) for s in b] for b, _ in found]
            both = [
                [dict(zip(("kind", "start", "end"), s)) for s in sorted(b + a, key=lambda s: (s[1], order[s[0]]))]
                for b, a in found
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(both, span)], ["id", "base", "spans"]
            )

    kind = dict(docs.dtypes)[id_col]
    spans = "array<struct<kind:string,start:int,end:int>>"
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, base {spans}, spans {spans}")


def listing(column: str) -> Column:
    """An array of spans as text: kind:start:end, joined by commas."""
    return F.concat_ws(
        ",",
        F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
    )


def counted(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlaps become one."""
    base, added = all_spans(text)
    out, done = [], 0
    for kind, start, end in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += text[done:start], f"[{kind.upper()}]"
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` with personal data masked in ``text_col``.

    ``length_col``, if given, is set to the new length in code points. Null texts stay null.
    """
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    clean = map_batches(docs, run, schema)
    if length_col is None:
        return clean
    length = F.length(text_col).cast(dict(docs.dtypes)[length_col])
    return clean.withColumn(length_col, length)
