"""Personal data: anchors are found in one pass, and local parsers expand them to spans.

An Aho-Corasick automaton runs once over a text and stops at at-signs, plus signs, digits, scheme
marks and identifier cues (words such as IBAN or account). From an anchor a small parser walks left
and right to the boundaries of what stands there and checks it: host names, parts of an IP, check
digits of cards and IBANs, numbers that were never given out. Every character is walked over a bounded
number of times per kind, so time is linear in the text.

Base spans are what these expressions match, leftmost and without overlap per kind, matches that fail
their check being dropped: email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, ip (four numbers
up to 255), card (14 to 19 digits, Luhn), phone (10 to 15 digits). Added spans have kinds of their own:
``address`` (mail addresses with letters beyond ASCII, quoted names, hosts in brackets, spelled-out
at-signs), ``login`` (a scheme's authority that names a user) and ``account`` (a cue and a valid number
behind it). One that lies inside a base span is left out; of those of one kind that overlap, the first stays.

Defined cases: null and empty texts have no spans; a null id stays null; repeated rows are each answered;
other columns are not looked at; an empty table gives an empty one; long texts are taken whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.llm.registry import query, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("address", "login", "account")
CUES = ("iban", "account", "acct", "passport", "ssn", "social security", "tax id", "konto", "compte", "cuenta")
SPELLED = ("(at)", "[at]", "{at}")
SPAN = "struct<kind: string, start: int, end: int, base: boolean>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
HOST = re.compile(r"[\w.-]++")
HOST_IP = re.compile(r"\[([0-9.]{7,15})\]")
SPELLED_HOST = re.compile(r"[\w-]++(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[\w-]++)++", re.I)
DOT = re.compile(r"\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?", re.I)
SCHEME_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
AUTHORITY = re.compile(r"[^\s/?#\"'<>]++")
PORT = re.compile(r":[0-9]{1,5}$")
LINK = re.compile(r"(?:\s?(?:number|nummer|num|no|nr)\b\.?)?\s{0,2}(?:[:#=]|is\b)?\s{0,2}", re.I)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,60}")
SOCIAL = re.compile(r"([0-9]{3})[ -]?([0-9]{2})[ -]?([0-9]{4})(?!\w)")
NUMBER = re.compile(r"[A-Z]{0,3}[0-9](?:[ -]?[0-9]){5,17}(?!\w)")


def automaton() -> ahocorasick.Automaton:
    """Each pattern's value is its length and what it hints at."""
    found = ahocorasick.Automaton()
    for sign, hint in [("@", "at"), ("＠", "at"), ("+", "plus"), ("://", "scheme")] + [(s, "spelled") for s in SPELLED] + [(d, "digit") for d in "0123456789"]:
        found.add_word(sign, (len(sign), hint))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, (len(form), "cue"))
    found.make_automaton()
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    odd = [int(d) for d in digits[-1::-2]]
    even = [2 * int(d) for d in digits[-2::-2]]
    return (sum(odd) + sum(d - 9 if d > 9 else d for d in even)) % 10 == 0


def _real_host(host: str) -> bool:
    labels = host.split(".")
    return (len(host) <= 253 and len(labels) > 1 and "_" not in host and labels[-1].isalpha() and len(labels[-1]) > 1
            and all(x and x[0] != "-" and x[-1] != "-" for x in labels))


def _ip(host: str) -> bool:
    parts = host.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)


def _name_before(text: str, at: int) -> int | None:
    """Where the name left of an at-sign begins: quoted, or letters of any script, at most 64."""
    if at and text[at - 1] == '"':
        start = text.rfind('"', max(0, at - 66), at - 1)
        return start if start >= 0 and start < at - 2 and "\n" not in text[start:at] else None
    start = at
    while start and at - start <= 64 and (text[start - 1] in LOCAL or text[start - 1].isalnum()):
        start -= 1
    while start < at and text[start] in "._%+-":
        start += 1
    name = text[start:at]
    return start if 0 < len(name) <= 64 and name[-1] != "." and ".." not in name else None


def wide_address(text: str, at: int) -> tuple[int, int] | None:
    start = _name_before(text, at)
    if start is None:
        return None
    inside = HOST_IP.match(text, at + 1)
    if inside:
        return (start, inside.end()) if _ip(inside[1]) else None
    host = HOST.match(text, at + 1)
    if not host:
        return None
    name = host[0].rstrip("._-")
    return (start, at + 1 + len(name)) if _real_host(name) else None


def spelled_address(text: str, first: int, end: int) -> tuple[int, int] | None:
    left = first - 1 if first and text[first - 1] == " " else first
    right = end + 1 if text[end:end + 1] == " " else end
    start, host = _name_before(text, left), SPELLED_HOST.match(text, right)
    if start is None or not host or not _real_host(DOT.sub(".", host[0])):
        return None
    return start, host.end()


def login(text: str, first: int, end: int) -> tuple[int, int] | None:
    start = first
    while start and first - start < 32 and text[start - 1] in SCHEME_LEFT:
        start -= 1
    while start < first and not text[start].isalpha():
        start += 1
    found = AUTHORITY.match(text, end)
    if start == first or not found:
        return None
    authority = found[0].rstrip(".,;:!)]}")
    user, sign, host = authority.rpartition("@")
    host = PORT.sub("", host)
    return (start, end + len(authority)) if sign and user.strip(":") and (_real_host(host) or _ip(host) or host == "localhost") else None


def account(text: str, first: int, end: int) -> tuple[int, int] | None:
    """The number behind a cue that stands by itself."""
    if (first and text[first - 1].isalnum()) or text[end:end + 1].isalnum():
        return None
    at = LINK.match(text, end).end()
    iban = IBAN.match(text, at)
    if iban:
        stops = [m.start() for m in re.finditer(" ", iban[0])] + [len(iban[0])]
        for stop in reversed(stops):
            value = iban[0][:stop].replace(" ", "")
            if 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1 and not text[at + stop:at + stop + 1].isalnum():
                return at, at + stop
    if text[first:end].lower() in ("ssn", "social security"):
        found = SOCIAL.match(text, at)
        return found.span() if found and found[1] not in ("000", "666") and found[1] < "900" and found[2] != "00" and found[3] != "0000" else None
    found = NUMBER.match(text, at)
    return found.span() if found else None


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) in order."""
    base, more = [], set()
    mail_end = phone_end = chain_end = dots_end = 0
    for last, (size, hint) in anchors.iter(text):
        if hint == "digit":
            if last >= chain_end:
                chain_end = CHAIN.match(text, last).end()
                if chain_end - last >= 14:
                    digits = NO_DIGIT.sub("", text[last:chain_end])
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        base.append((last, 2, chain_end))
            if last >= dots_end:
                dotted = DOTTED.match(text, last)
                dots_end = dotted.end()
                if dots_end - last >= 7:
                    at, parts = last, dotted[0].split(".")
                    for i in range(0, len(parts) - 3, 4):
                        four = parts[i:i + 4]
                        stop = at + sum(map(len, four)) + 3
                        if all(map(_small, four)):
                            base.append((at, 1, stop))
                        at = stop + 1
        elif hint == "at":
            start = last
            if text[last] == "@":
                while start > mail_end and text[start - 1] in LOCAL:
                    start -= 1
                host = DOMAIN.match(text, last + 1) if start < last else None
                if host:
                    mail_end = host.end()
                    base.append((start, 0, mail_end))
            more.add((4, wide_address(text, last)))
        elif hint == "plus":
            found = PHONE.match(text, last)
            if found and 10 <= len(NO_DIGIT.sub("", found[0])) <= 15:
                base.append((last, 3, found.end()))
        elif hint == "spelled":
            more.add((4, spelled_address(text, last - size + 1, last + 1)))
        elif hint == "scheme":
            more.add((5, login(text, last - size + 1, last + 1)))
        else:
            more.add((6, account(text, last - size + 1, last + 1)))
    base.sort()
    return sorted(base + _added(base, more)) if more else base


def _added(base: list[tuple[int, int, int]], more: set) -> list[tuple[int, int, int]]:
    starts, reach = [s for s, _, _ in base], []
    for _, _, end in base:
        reach.append(max(end, reach[-1]) if reach else end)
    out, ends = [], {}
    for kind, (start, end) in sorted((k, s) for k, s in more if s):
        at = bisect_right(starts, start)
        if not (at and reach[at - 1] >= end) and start >= ends.get(kind, 0):
            out.append((start, kind, end))
            ends[kind] = end
    return out


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every run of overlapping spans replaced by the kind of its first."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind]}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: bool = False) -> DataFrame:
    """doc_id, spans (kind, start, end in code points, base) in order; with ``mask`` also the masked text."""
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches):
        anchors = automaton()
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            found = [spans_of(t, anchors) for t in texts]
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": k < len(BASE_KINDS)} for s, k, e in spans] for spans in found]
            out = {"doc_id": batch["doc_id"], "spans": pa.array(rows, pa.list_(span))}
            if mask:
                out["masked"] = pa.array([masked(t, s) for t, s in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return own.mapInArrow(run, f"doc_id long, spans array<{SPAN}>" + (", masked string" if mask else ""))


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op13_private_data")
def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many base spans of each kind, their hash, and all spans."""
    found = find_private(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of_kind(kind) for kind in BASE_KINDS]
    base = as_text(F.filter("spans", lambda s: s["base"]))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
