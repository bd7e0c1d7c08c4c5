"""Secret scans by reading assignments.

A lexer reads name-literal pairs from source and configuration syntax: ``name = "..."``, ``name: value``, ``"name" => '...'``,
``export NAME=value``, ``<name>value</name>``, ``--name value``, and calls whose last argument is a literal, ``set_password("...")``. Block comments
between them are blanks. Literals and names that are joined by + are one value. Entries of a map that has a name of weight 3 or more inherit it. Constants
propagate, through any number of steps: a bare name, ``${name}`` or ``$name`` stands for the literals of its nearest earlier definition, or of its first
later one, so a literal with a harmless name counts as secret once it flows to a sensitive one. Literals are scored by the names they reach and by how random they look; those at or
above ``threshold`` are reported as ``literal`` spans. Three fixed shapes are always reported: assign, access and hex.
All spans are in code points, end exclusive.

Null and empty texts have no spans. Texts are read whole, one at a time; repeated rows are scanned again and give the same.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import map_batches

Span = tuple[str, int, int]

#: Fixed shapes.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")

#: Parts of names and how much they say that the value is secret.
NAME_WEIGHTS = {"password": 3, "passwd": 3, "pass": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 2, "apikey": 3, "credential": 2, "credentials": 2,
                "auth": 2, "authorization": 2, "bearer": 2, "private": 1, "access": 1, "api": 1, "key": 1, "signing": 1, "encryption": 1, "session": 1, "salt": 1}
PLAIN = re.compile(r"(?i)example|changeme|placeholder|dummy|sample|your[_-]|xxxx|\*\*\*|^(true|false|null|none|undefined|test)$")
NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
QUOTED = r'"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`[^`\n]*`'
OPERAND = rf"(?:{QUOTED}|\$\{{?{NAME}\}}?|[A-Za-z0-9+/_.=~$-]+)"
PAIR = re.compile(
    rf"""(?P<name>{NAME})["'\]]?[\x20\t]*(?:=>|:=|=(?!=)|:(?!:))[\x20\t]*(?P<value>{OPERAND}(?:[\x20\t]*\+[\x20\t]*{OPERAND})*)"""
    rf"""|<(?P<tag>{NAME})>(?P<body>[^<\n]+)</(?P=tag)>|--(?P<flag>{NAME})[\x20=](?P<word>[^\s"']+|{QUOTED})"""
    rf"""|(?P<call>{NAME})\([^()\n"'`=]*(?P<last>{QUOTED})[\x20\t]*\)""", re.A)
PIECE = re.compile(rf"(?:^|[\x20\t]*\+[\x20\t]*)({OPERAND})", re.A)
COMMENT = re.compile(r"/\*.*?\*/", re.S)
#: Braces, with the name that a map was given; quoted braces do not count.
SCOPE = re.compile(rf"""["']?(?P<name>{NAME})["']?\s*(?:=>|=|:)\s*\{{|{QUOTED}|(?P<brace>[{{}}])""", re.A)
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[Span]:
    """The three fixed shapes: leftmost matches that do not overlap within a kind, less those that are too short."""
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def name_score(name: str) -> int:
    parts = [part.lower() for part in NAME_PART.findall(name)]
    return sum(NAME_WEIGHTS.get(part, 0) for part in dict.fromkeys(parts)) + (2 if "apikey" in "".join(parts) and "apikey" not in parts else 0)


def literal_score(value: str) -> int:
    """0 for values that cannot be secret, up to 3 for long random ones."""
    if len(value) < 8 or PLAIN.search(value) or len(set(value)) < 4:
        return 0
    classes = sum(bool(re.search(kind, value)) for kind in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    if re.search(r"\s", value) or classes < 2:
        return 0
    return 1 + (bits >= 3.0) + (len(value) >= 16)


def scopes(text: str) -> list[tuple[int, int, str]]:
    """(start, end, name) of maps whose name alone has weight 3 or more; an open one reaches to the end."""
    found, stack = [], []
    for m in SCOPE.finditer(text):
        if m["name"] or m["brace"] == "{":
            stack.append((m.end(), m["name"] or ""))
        elif m["brace"] and stack:
            start, name = stack.pop()
            found.append((start, m.start(), name))
    found += [(start, len(text), name) for start, name in stack]
    return [one for one in found if name_score(one[2]) >= 3]


def pairs(text: str) -> list[tuple[str, list[tuple[str, int, int, bool]]]]:
    """(name, operands) in order; an operand is (value, start, end, whether it may be a name)."""
    found = []
    for m in PAIR.finditer(text):
        group, label = next((g, n) for g, n in (("value", "name"), ("body", "tag"), ("word", "flag"), ("last", "call")) if m[g] is not None)
        at, operands = m.start(group), []
        pieces = [(at, m.end(group))] if group in ("body", "word") else [(at + p.start(1), at + p.end(1)) for p in PIECE.finditer(m[group])]
        for a, b in pieces:
            quoted = text[a] in "\"'`" and b - a > 1
            operands.append((text[a + 1:b - 1], a + 1, b - 1, False) if quoted else (text[a:b], a, b, group == "value"))
        found.append((m[label], operands))
    return found


def resolved(known: list, index: int, defined: dict[str, list[int]]) -> list[tuple[str, int, int]]:
    """(value, start, end) of the literals that make up the value of pair ``index``; names stand for what they were given, each definition once, so circles
    end and long chains cost their length."""
    out, seen = [], {index}
    waiting = [(index, operand) for operand in reversed(known[index][1])]
    while waiting:
        owner, (value, start, end, bare) = waiting.pop()
        places = defined.get(value.strip("${}"), []) if bare else []
        at = bisect.bisect_left(places, owner)
        source = places[at - 1] if at else next((k for k in places if k != owner), None)
        if source is None:
            out.append((value, start, end))
        elif source not in seen:
            seen.add(source)
            waiting += [(source, operand) for operand in reversed(known[source][1])]
    return out


def literal_spans(text: str, threshold: int = 5) -> list[Span]:
    """Literals whose own name, or a name they flow to, is sensitive and that look random enough."""
    lower = text.lower()
    if not any(sign in text for sign in ("=", ":", "--", "</", "(")) or not any(word in lower for word in NAME_WEIGHTS):
        return []
    if "/*" in text:
        text = COMMENT.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text)
    known, defined = pairs(text), {}
    for index, (name, _) in enumerate(known):
        defined.setdefault(name, []).append(index)
    maps = scopes(text) if "{" in text else []
    best: dict[tuple[int, int], int] = {}
    for index, (name, operands) in enumerate(known):
        own = name_score(".".join([name, *(n for a, b, n in maps if a <= operands[0][1] < b)]))
        if own < 2:
            continue
        parts = resolved(known, index, defined)
        if looks := literal_score("".join(value for value, _, _ in parts)):
            for _, start, end in parts:
                best[start, end] = max(best.get((start, end), 0), own + looks)
    return [("literal", a, b) for (a, b), score in best.items() if score >= threshold and b > a]


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_text(text: str | None) -> list[Span]:
    """All spans by start, then kind. A literal that a fixed shape covers in full is not reported again."""
    if not text:
        return []
    base = base_spans(text)
    extra = [s for s in literal_spans(text) if not any(a <= s[1] and s[2] <= b for _, a, b in base)]
    return ordered([*base, *extra])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, spans) of each row; spans as array of (kind, start, end)."""
    def run(batches):
        for batch in batches:
            yield {"key": batch["key"], "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(text)] for text in batch["text"]]}

    rows = df.select(F.col(key).alias("key"), F.col(column).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, run, f"key {kind}, spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("key", key)


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest columns of scanned rows."""
    def text_of(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "literal")
    rest = [c for c in found.columns if c != "spans"]
    return found.select(*rest, *[count(kind) for kind in KINDS], F.sha2(text_of(base), 256).alias("base_sha256"),
                        text_of(F.col("spans")).alias("spans"))


def redact(df: DataFrame, column: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every span; overlapping spans become one mark. Null stays null, and all other columns stay."""
    def clean(text):
        spans = scan_text(text)
        if not spans:
            return text
        out, at = [], 0
        for start, end in merged((a, b) for _, a, b in spans):
            out += [text[at:start], mark]
            at = end
        return "".join(out) + text[at:]

    def run(batches):
        for batch in batches:
            yield batch | {column: [clean(text) for text in batch[column]]}

    return map_batches(df, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema))


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
