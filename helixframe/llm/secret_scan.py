"""Secret scans: literals that source and configuration syntax gives to sensitive names.

Three plain patterns find well-known shapes. Around them an assignment-aware
lexer goes from operator to operator (``=``, ``:``, ``=>``, ``:=`` and the end of an
element's tag). Behind each it reads the target: a name, a quoted key, the keys and the table
of a subscript, or a name with its type. After it, it reads the value: terms joined by
``+`` or standing side by side, each a name or a literal. Literals are bare words, strings with
escapes, triple-quoted strings, escaped strings inside others, and indented
blocks. The strings that a call is given count as its value, unless it looks something up or they are
names themselves. Targets and values in lists of equal length belong together by their places. The password in an
address and the body of an armoured private key have their names from the syntax around them. A name stands for the constants that it was given before, so constants flow from
name to name. Each literal is scored by the most sensitive name that it reaches and
by its own shape; those that score enough are secrets too, whatever they look like.
Comments and strings are read as well, as secrets are often commented out or quoted.

Defined cases: a null text is empty and has no span; spans count code points,
ends are exclusive; equal spans of one kind count once; a span of the lexer that
lies wholly inside one of the patterns is left to it, others may overlap or hold each other;
repeated rows and null keys are judged alike; names, literals and texts may be of any length; an
empty table gives an empty one; ``redact_secrets`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, map_arrow

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "named")

# Parts of names that speak of a secret wherever they stand, whole words of names that do, and how strongly.
PART_SCORES = {"password": 3, "passwd": 3, "passphrase": 3, "secret": 3, "apikey": 3, "accesskey": 3, "privatekey": 3, "sessionkey": 3, "encryptionkey": 3, "signingkey": 3, "credential": 3, "clientkey": 2}
WORD_SCORES = {"token": 3, "auth": 2, "authorization": 2, "bearer": 2, "pwd": 2, "signing": 2, "pass": 1}
# Literals that stand for a secret without being one, and words of such literals.
NOTHING = {"none", "null", "nil", "true", "false", "undefined"}
PLACEHOLDERS = {"example", "changeme", "placeholder", "your", "redacted", "dummy", "insert", "todo"}
#: Calls whose arguments say where a value is, not what it is.
LOOKUPS = {"get", "getenv", "env", "environ", "getpass", "input", "prompt", "read", "open", "load", "lookup", "find", "fetch", "property", "query", "select", "format", "print", "log"}
LEAST_SCORE = 5

#: Start, end and value of a literal; a name has no value.
Term = tuple[int, int, str | None]

_OP = re.compile(r"=>|:=|(?<![=!<>~])=(?![=~])|(?<!:):(?![:/]{1,2}/|:)|<([A-Za-z_][\w.-]*)(?:\s[^<>]*)?>")
_SPACE, _NAME_CHARS = " \t", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-$")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.$-]*\Z")
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
_KEY = re.compile(r"""\s*\\?(["'`])([^"'`\\]*)\\?\1\s*""")
_ATOM = r"""(?>["']?[A-Za-z_][A-Za-z0-9_.]*(?:\[[^\n=]*\]|<[^\n=]*>)?["']?(?:\[\])*)"""
#: A type between the colon after a name and ``=``; atomic groups, so that odd types cost little.
_TYPE = re.compile(rf"[ \t]*({_ATOM})(?:[ \t]*[|&][ \t]*{_ATOM})*+[ \t]*")
_STRING = re.compile(
    r"""(?:[rRbBuUfF]{0,2}|[@$L])(?:"{3}(?P<t3>(?:[^"\\]|\\.|"(?!""))*+)"{3}|\'{3}(?P<s3>(?:[^'\\]|\\.|'(?!\'\'))*+)'{3}"""
    r"""|"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<b>(?:[^`\\]|\\.)*+)`|\\(?P<q>["'])(?P<e>[^"'\\\n]*+)\\(?P=q))""",
    re.DOTALL,
)
_PREFIX = re.compile(r"(?:new|await)[ \t]+(?=[A-Za-z_])")
_GROUPS = ("t3", "s3", "d", "s", "b", "e")
_NAME_RUN, _KEY_LIKE = re.compile(r"[A-Za-z0-9_.\[\]]+"), re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")
_BARE = re.compile(r"""(?:(?:Bearer|Basic)[ ])?([A-Za-z0-9_][^\s"',;(){}<>\[\]]*)""")
#: Bare words of settings without spaces may begin with any sign.
_SETTING = re.compile(r"""([^\s"'`,;(){}<>\[\]=\\][^\s"',;(){}<>\[\]]*)""")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?\d?[ \t]*\n((?:[ \t]*\n)*([ \t]+)\S[^\n]*(?:\n(?:\2[^\n]*|[ \t]*(?=\n|\Z)))*)")
_PLUS = re.compile(r"[ \t]*[+&.][ \t]*(?:\\?\n[ \t]*)?")
_BESIDE = {False: re.compile(r"""[ \t]*(?:\\\n[ \t]*)?(?=["'])"""), True: re.compile(r"""\s*(?=["'])""")}
_ARMOUR = re.compile(r"-----[A-Z0-9 ]+-----")
_EDGE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]+)-----")
_ADDRESS = re.compile(r"""://[^\s:/@"'<>]*:([^\s/@"'<>]+)@(?=[\w\[])""")
_DECLARES = {"let", "var", "local", "const", "my", "val"}


class _Holder:
    """Tells whether some of the given spans holds another."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        order = sorted(spans)
        self.starts, self.furthest = [a for a, _ in order], list(accumulate((b for _, b in order), max))

    def holds(self, a: int, b: int) -> bool:
        k = bisect_right(self.starts, a)
        return k > 0 and self.furthest[k - 1] >= b


def literal_score(value: str) -> int:
    """How much a literal's own shape looks like a secret, 0 to 3."""
    low = value.lower()
    if len(value) < 8 or " " in value.strip() or low in NOTHING or low.startswith(("${", "{{", "<", "%(")) or PLACEHOLDERS & set(re.split("[^a-z]+", low)):
        return 0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return (bits >= 2.5) + (classes >= 2) + (len(value) >= 16 or classes >= 3)


def name_score(name: str) -> int:
    """How sensitive a target's name is, 0 to 3."""
    words = re.split("[^a-z]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower())
    joined = "".join(words)
    parts = [v for k, v in PART_SCORES.items() if k in joined and not (k == "secret" and "secretar" in joined)]
    return max([0, *parts, *(WORD_SCORES.get(w, WORD_SCORES.get(w.removesuffix("s"), 0)) for w in words)])


def _targets(text: str, at: int) -> list[str]:
    """The names that an operator at ``at`` gives a value: the last key or name first, then a sensitive table."""
    names: list[str] = []
    i = at
    while True:
        while i and text[i - 1] in _SPACE:
            i -= 1
        if i and text[i - 1] == "]":
            k = text.rfind("[", 0, i)
            if k < 0 or "\n" in text[k:i]:
                return names
            if (key := _KEY.fullmatch(text, k + 1, i - 1)) and (not names or name_score(key[2])):
                names.append(key[2])
            i = k
            continue
        if i and text[i - 1] in "?!":
            i -= 1
        elif i and text[i - 1] in "\"'`":
            i -= 1 + (i > 1 and text[i - 2] == "\\")
        j = i
        while j and text[j - 1] in _NAME_CHARS:
            j -= 1
        if (m := _NAME.search(text, j, i)) and (i == at or not names or name_score(m[0])):
            names.append(m[0])
        return names


def _target_list(text: str, at: int) -> list[str]:
    """The targets of an assignment to several, in their order; none if it is to one."""
    names: list[str] = []
    i = at
    while True:
        while i and text[i - 1] in _SPACE:
            i -= 1
        j = i
        while j and text[j - 1] in _NAME_CHARS:
            j -= 1
        if not (m := _NAME.match(text, j, i)):
            return []
        names.append(m[0])
        i = j
        while i and text[i - 1] in _SPACE:
            i -= 1
        if not i or text[i - 1] != ",":
            break
        i -= 1
    j = i
    while j and text[j - 1].isalpha():
        j -= 1
    return names[::-1] if len(names) > 1 and (not i or text[i - 1] in "\n;{" or text[j:i] in _DECLARES) else []


def _value_list(text: str, at: int) -> list[list[Term]]:
    """The terms of each value of a list up to the end of its statement; none if there is anything else in it."""
    values = []
    while True:
        terms, at = _values(text, at, ",")
        values.append(terms)
        while at < len(text) and text[at] in _SPACE:
            at += 1
        if at == len(text) or text[at] in "\n\r;#":
            return values
        if text[at] != ",":
            return []
        at += 1


def _arguments(text: str, at: int, callee: str) -> tuple[list[Term], int]:
    """Strings in the call that opens at ``at``, and where it ends; named arguments end the reading, as they have their own operator."""
    words = re.split("[^a-z]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", callee).lower())
    out: list[Term] = []
    depth, looks_up, i = 1, bool(LOOKUPS & set(words)), at + 1
    while i < len(text) and depth:
        if m := _STRING.match(text, i):
            group = next(k for k in _GROUPS if m[k] is not None)
            if not looks_up and not (_KEY_LIKE.match(m[group]) and name_score(m[group])):
                out.append((m.start(group), m.end(group), m[group]))
            i = m.end()
        elif m := _NAME_RUN.match(text, i):
            i = m.end()
            looks_up = looks_up or (text[i : i + 1] == "(" and bool(LOOKUPS & set(re.split("[^a-z]+", m[0].lower()))))
        elif text[i] in "()":
            depth += 1 if text[i] == "(" else -1
            i += 1
        elif text[i] in ", \t\r\n":
            i += 1
        else:
            break
    return out, i


def _values(text: str, at: int, op: str) -> tuple[list[Term], int]:
    """The terms of the value after an operator and where it ends: (start, end, value) of a literal, with None for a name."""
    out: list[Term] = []
    if op == ":" and (m := _BLOCK.match(text, at)):
        return [(m.start(1) + len(m[1]) - len(m[1].lstrip()), m.end(1), "".join(x.strip() for x in _ARMOUR.sub("", m[1]).split("\n")))], m.end()
    if op == "<":
        end = text.find("<", at)
        if end > at and (inner := text[at:end].strip()):
            start = at + text[at:end].index(inner)
            out.append((start, start + len(inner), inner))
        return out, max(at, end)
    i = at
    while i < len(text) and text[i] in _SPACE:
        i += 1
    wrapped = False
    while i < len(text) and text[i] == "(":
        wrapped, i = True, i + 1
        while i < len(text) and text[i].isspace():
            i += 1
    strings: list[tuple[int, int, str]] = []
    while True:
        if m := _STRING.match(text, i):
            group = next(k for k in _GROUPS if m[k] is not None)
            raw = m[group]
            value = re.sub(r"\\(.)", r"\1", raw, flags=re.DOTALL) if "\\" in raw else raw
            if group in ("t3", "s3", "b") and "\n" in value:
                value = "".join(x.strip() for x in _ARMOUR.sub("", value).split("\n"))
            strings.append((m.start(group), m.end(group), value))
            i = m.end()
            follow = _PLUS.match(text, i) or _BESIDE[wrapped].match(text, i)
        elif m := _PREFIX.match(text, i):
            i = m.end()
            continue
        elif m := _BARE.match(text, i) or (i == at and op == "=" and _SETTING.match(text, i)) or None:
            name = _IDENT.match(m[1])
            i = m.end()
            if name and text[i : i + 1] == "(":
                given, i = _arguments(text, i, m[1])
                out += given
            else:
                out.append((m.start(1), m.end(1), None if name else m[1]))
            follow = _PLUS.match(text, i) if name else None
        else:
            break
        if not follow:
            break
        i = follow.end()
    if strings:
        out.append((strings[0][0], strings[-1][1], "".join(v for _, _, v in strings)))
    return out, i


def named_literals(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, name, score) of literals that reach a sensitive name."""
    constants: dict[str, list[tuple[int, int, str]]] = {}  # what a name holds so far
    found: dict[tuple[int, int], tuple[str, int]] = {}
    last: tuple[str, int, list[str]] = ("", 0, [])  # the operator before this one, its end and its targets
    for m in _OP.finditer(text):
        op, begin, end = text[m.start()] if m[1] else m[0], m.start(), m.end()
        names = [m[1]] if m[1] else _targets(text, begin)
        if op == "=" and last[0] == ":" and last[2] and _TYPE.fullmatch(text, last[1], begin):
            # The word before ``=`` is the type, unless it speaks of a secret itself.
            names = [*last[2], *(n for n in names if name_score(n))]
        last = (op, end, names)
        if not names:
            continue
        several = _target_list(text, begin) if op in ("=", ":=") else []
        each = _value_list(text, end) if several else []
        given = [([name], terms) for name, terms in zip(several, each, strict=True)] if len(several) == len(each) and several else [(names, _values(text, end, op)[0])]
        before = [[x for a, b, value in terms for x in (constants.get(text[a:b], []) if value is None else [(a, b, value)])] for _, terms in given]
        for (names, _), literals in zip(given, before, strict=True):
            # Only literals that some name can make a secret are worth following.
            literals = [x for x in dict.fromkeys(literals) if literal_score(x[2]) >= LEAST_SCORE - 3]
            for name in names:
                constants[name] = literals
            name = max(names, key=name_score)
            if sensitive := name_score(name):
                for a, b, value in literals:
                    if (score := sensitive + literal_score(value)) >= LEAST_SCORE and score > found.get((a, b), ("", 0))[1]:
                        found[a, b] = (name, score)
    holder = _Holder(found)
    for a, b, name, value in _named_by_syntax(text):
        if not holder.holds(a, b) and (score := name_score(name) + literal_score(value)) >= LEAST_SCORE:
            found.setdefault((a, b), (name, score))
    return [(a, b, *v) for (a, b), v in found.items()]


def _named_by_syntax(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, value) of passwords in addresses and bodies of armoured private keys."""
    for m in _ADDRESS.finditer(text):
        yield m.start(1), m.end(1), "password", m[1]
    opened = None
    for m in _EDGE.finditer(text):
        if m[1] == "END" and opened and opened[2] == m[2] and "PRIVATE KEY" in m[2]:
            body = text[opened.end() : m.start()]
            start = opened.end() + len(body) - len(body.lstrip())
            yield start, start + len(body.strip()), m[2], re.sub(r"\s+|\\n", "", body)
        opened = m if m[1] == "BEGIN" else None


def find_spans(text: str) -> list[tuple[int, int, int, str, int]]:
    """(start, kind, end, name, score) of every span of a text, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in ("password", "passwd", "secret", "token", "apikey", "api_key")) or not text.isascii():
        out += [(m.start(), 0, m.end(), m[1], 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), "", 0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end(), "", 0) for m in HEX.finditer(text)]
    plain = _Holder((s[0], s[2]) for s in out)
    for a, b, name, score in named_literals(text):
        if b > a and not plain.holds(a, b):
            out.append((a, 3, b, name, score))
    return sorted(out)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end, name, score) for every text."""
    element = "struct<kind:string,start:int,end:int,name:string,score:int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.int32())]))
        for b in batches:
            spans = [
                [{"kind": KINDS[k], "start": a, "end": e, "name": n, "score": s} for a, k, e, n, s in find_spans(t or "")] for t in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, f"doc_id long, spans array<{element}>")


def secret_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every text."""
    spans = scan_secrets(docs, key, text)
    line = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda x: x["kind"] != "named")
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def redact_secrets(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans become one mask."""

    def redact(t: str | None) -> str | None:
        if t is None:
            return None
        parts, at = [], 0
        for a, _, e, _, _ in find_spans(t):
            if a >= at:
                parts += [t[at:a], mask]
            at = max(at, e)
        return "".join([*parts, t[at:]]) if parts else t

    i, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            cols[i] = pa.array([redact(t) for t in cols[i].to_pylist()], cols[i].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_arrow(docs, run, docs.schema)
