"""Secret scans: assignment-aware lexing beside three plain patterns.

The lexer reads targets, then expressions, into name-literal pairs. Targets: a name before ``=``, ``:``,
``:=`` or ``=>`` (quoted, dotted, annotated with a type, chained, a keyword argument), a subscript
(``cfg["name"] =``), the key of a call (``put("name", x)``), a setter (``set_name(x)``, ``name.set(x)``),
an XML element or a name/value attribute pair, a YAML block scalar. Expressions: literals (quoted, triple-quoted,
prefixed, bare), joined by ``+``, ``.``, ``..``, ``||`` or by standing side by side, interpolations
(``f"{x}"``, ``${x}``), defaults (``${x:-literal}``, ``getenv("X", "literal")``, ``a or "literal"``) and
literals wrapped in a call.
Constants are propagated: a name assigned from another name or from ``${other}`` takes over that
name's literal, wherever in the text it is defined. A joined literal is scored as one: by how
sensitive the names that it reaches are, and by its own shape; the parts of those at or over the threshold
are reported. The plain patterns (keyword assignments, access keys, long hex runs) always stay.

Scale: one pass over the input, no shuffle; memory is bounded by a batch and one text's pairs.

Defined results: offsets are code points, end exclusive. A null text is empty. Repeated rows are
scanned each by itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as [0-9a-f]+ gives them, of 32 characters and more

# Targets. A name is its whole run, however long; nothing in it can start the operator, so it is never given back.
_TARGET = re.compile(
    r"""(?:(?<![\w.$-])["']?(?P<name>[A-Za-z_][\w.-]*+)["']?[ \t]*"""
    r"""(?::[ \t]*[A-Za-z_][\w.]*+(?:\[[\w., \[\]|]*\])?(?:[ \t]*\|[ \t]*\w+|\?)*[ \t]+=(?=[ \t]*[\w"'`$])"""  # a type between
    r"""|(?<=[ \t])(?:string|str)[ \t]*=(?!=)|:=|=>|=(?![=>])|:(?!//|:))"""
    r"""|\[[ \t]*["'](?P<key>[^"'\n\]]*)["'][ \t]*\][ \t]*=(?![=>])"""
    r"""|\([ \t]*["'](?P<arg>[A-Za-z_][\w.-]*+)["'][ \t]*,"""
    r"""|(?<![\w.])(?P<call>[A-Za-z_][\w.]*+)\((?=[ \t]*[rbuRBU]?["'`]))[ \t]*""", re.A)
_SETTER = re.compile(r"(?:.*\.)?set_?(?P<a>[A-Za-z]\w*)$|(?P<b>.+)\.set$", re.A)
# Expressions
_TERM = re.compile(
    r"""(?P<prefix>[rbufRBUF]{1,2}(?=["']))?"""
    r"""(?:"{3}(?P<td>.*?)"{3}|'{3}(?P<ts>.*?)'{3}"""
    r"""|"(?P<dq>(?:[^"\\\n]|\\.)*)"|'(?P<sq>(?:[^'\\\n]|\\.)*)'|`(?P<bq>[^`\n]*)`)"""
    r"""|\$\{(?P<dref>[A-Za-z_]\w*):?[-=](?P<default>[^}\n]*)\}|\$\{?(?P<ref>[A-Za-z_]\w*)\}?"""
    r"""|(?P<func>[A-Za-z_][\w.:]*+)\([ \t]*(?=[rbufRBUF]{0,2}["'])"""
    r"""|(?P<item>[A-Za-z_][\w.]*+)\[[ \t]*["'](?P<of>[^"'\n\]]+)["'][ \t]*\]"""
    r"""|(?P<bare>[^\s,;"'`(){}\[\]<>]+)""", re.A | re.S)
_JOINED = re.compile(r"""[ \t]*(?:\+|\.\.|\.(?=[ \t]*["'])|\|\|(?=[ \t]*["'])|(?=["']))(?:\\?\n)?[ \t]*""")
_OPEN = re.compile(r"""\(\s*(?=[rbufRBUF]{0,2}["'])""")
_JOINED_INSIDE = re.compile(r"""\s*(?:\+\s*)?(?=[rbufRBUF]{0,2}["'])""")  # parentheses hold line ends, too
_OTHERWISE = re.compile(r"""[ \t]*(?:\bor\b|\?\?|\|\|)[ \t]*""")
_NEXT_ARGUMENT = re.compile(r"""[ \t]*,[ \t]*(?=[rbufRBUF]{0,2}["'])""")
_GETTER = re.compile(r"(?:^|[._])(?:get_?env|env|get|get_?property|get_?or_?default|get_?string)$", re.I | re.A)
_HOLE = re.compile(r"\$\{([A-Za-z_]\w*)\}", re.A)
_F_HOLE = re.compile(r"\{([A-Za-z_][\w.]*)(?:[!:][^{}]*)?\}", re.A)
# Whole constructs
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:-]*+)(?:\s[^<>]*)?>\s*(?P<value>[^<>]*[^<>\s])\s*</(?P=name)\s*>", re.A)
_ATTRIBUTES = re.compile(r"""\b(?:name|key)=["'](?P<name>[^"'<>\n]+)["']\s+value=["'](?P<value>[^"'<>\n]+)["']""", re.A)
_BLOCK = re.compile(r"""^(?P<indent>[ \t]*)(?:-[ \t]+)?["']?(?P<name>[A-Za-z_][\w.-]*+)["']?:[ \t]*[|>][+-]?\d?[ \t]*\n"""
                    r"""(?P<value>(?:(?P=indent)[ \t]+\S.*(?:\n|\Z))+)""", re.A | re.M)
_LINE = re.compile(r"\S(?:.*\S)?")
_REFERENCE = re.compile(r"[A-Za-z_][\w.]*", re.A)
_WHOLE_REFERENCE = re.compile(r"\$\{?([A-Za-z_]\w*)\}?$", re.A)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_PLACEHOLDER = re.compile(r"^(?:x+|\*+|\.+|<.*>|\{.*\}|%.*|none|null|true|false|todo|redacted)$"
                          r"|example|changeme|placeholder|your[_-]|dummy|sample", re.I)

#: Points of the words of a name; the sum over its words is the name's sensitivity.
SENSITIVE = {"password": 5, "passwd": 5, "pwd": 5, "passphrase": 5, "secret": 5, "token": 4, "apikey": 5,
             "credential": 4, "credentials": 4, "bearer": 4, "private": 2, "access": 2, "api": 2, "auth": 3,
             "key": 2, "signing": 2, "encryption": 2, "client": 1, "pass": 3, "pin": 2, "salt": 2, "cookie": 2,
             "session": 2}
HARMLESS = {"count", "length", "len", "size", "max", "min", "limit", "type", "name", "url", "uri", "path", "file",
            "expires", "expiry", "ttl", "timeout", "field", "label", "hint", "format", "policy", "index", "public"}
THRESHOLD = 7


def name_score(name: str) -> int:
    """How sensitive a target name is, from its words (camelCase, snake_case, dotted)."""
    words = [w.lower() for w in _PARTS.findall(name.rsplit(".", 1)[-1])]
    if not words or words[-1] in HARMLESS or "public" in words:
        return 0
    return sum(SENSITIVE.get(w, 0) for w in words)


def literal_score(text: str) -> int:
    """How much a literal looks like a random secret: length, character classes, entropy."""
    n = len(text)
    if n < 8 or " " in text or _PLACEHOLDER.search(text):
        return -9
    classes = sum(bool(re.search(p, text, re.A)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^a-zA-Z0-9]"))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    return (n >= 12) + (n >= 20) + min(classes, 3) - 1 + (entropy >= 3.0) + (entropy >= 3.6) - 3 * (classes == 1)


#: A literal's parts (start, end), in order, or the name whose value is taken over.
Value = tuple[list[tuple[int, int]], str | None]


def _string(text: str, m: re.Match) -> tuple[list[tuple[int, int]], list[str]]:
    """(parts, names in its holes) of a quoted term."""
    group = next(g for g in ("td", "ts", "dq", "sq", "bq") if m[g] is not None)
    lo, hi = m.span(group)
    if whole := _WHOLE_REFERENCE.match(text[lo:hi]):
        return [], [whole[1]]
    hole = _F_HOLE if "f" in (m["prefix"] or "").lower() else _HOLE
    parts, names = [], []
    for h in hole.finditer(text, lo, hi):
        parts.append((lo, h.start()))
        names.append(h[1])
        lo = h.end()
    return [p for p in [*parts, (lo, hi)] if p[0] < p[1] or not parts], names


def expression(text: str, at: int) -> tuple[list[Value], int]:
    """(values, end of the last literal read, or ``at``) of the expression that begins at ``at``."""
    values: list[Value] = []
    parts: list[tuple[int, int]] = []  # of the literal being joined
    end = at
    joined = _JOINED
    if m := _OPEN.match(text, at):
        at, joined = m.end(), _JOINED_INSIDE

    def close():
        if parts:
            values.append((parts[:], None))
            parts.clear()

    while m := _TERM.match(text, at):
        at = m.end()
        if m["func"]:
            getter = _GETTER.search(m["func"])
            close()
            first = True
            while a := _TERM.match(text, at):
                if a["func"] or not any(a[g] is not None for g in ("td", "ts", "dq", "sq", "bq")):
                    break
                inner, names = _string(text, a)
                if first and getter and inner:
                    values.append(([], text[inner[0][0]:inner[-1][1]]))  # the setting that is read
                else:
                    values += [([], x) for x in names]
                    if inner:
                        values.append((inner, None))
                first, end = False, a.end()
                more = _NEXT_ARGUMENT.match(text, end)
                at = more.end() if more else end
                if not more:
                    break
            if text[at:at + 1] == ")":
                at += 1
        elif m["dref"]:
            close()
            values.append(([], m["dref"]))
            if m["default"]:
                values.append(([m.span("default")], None))
            end = at
        elif m["ref"]:
            values.append(([], m["ref"]))
        elif m["item"]:
            values.append(([], m["of"]))
        elif m["bare"]:
            value = m["bare"]
            if inner := _WHOLE_REFERENCE.match(value):
                values.append(([], inner[1]))
            elif _REFERENCE.fullmatch(value.rstrip(".")) and not any(c.isdigit() for c in value):
                values.append(([], value.rstrip(".")))
            else:
                close()
                values.append(([m.span("bare")], None))
                end = at
        else:
            inner, names = _string(text, m)
            parts += inner
            values += [([], x) for x in names]
            end = at
        if other := _OTHERWISE.match(text, at):
            close()
            at = other.end()
        elif more := joined.match(text, at):
            at = more.end()
        else:
            break
    close()
    return values, end


def pairs(text: str) -> list[tuple[str, list[tuple[int, int]], str | None]]:
    """(name, parts, reference): the parts of a literal, or the name whose value is taken over."""
    out, at = [], 0
    while m := _TARGET.search(text, at):
        at = m.end()
        if m["call"]:
            setter = _SETTER.match(m["call"])
            if not setter:
                at = m.end("call")  # the key of a call may follow
                if k := _TARGET.match(text, at):
                    m, at = k, k.end()
                else:
                    continue
            name = (setter["a"] or setter["b"]) if setter else m["arg"]
            if name is None:
                continue
        else:
            name = m["name"] or m["key"] or m["arg"] or ""
        values, at = expression(text, at)
        out += [(name.rstrip(".-"), parts, ref) for parts, ref in values]
    for rule, mark in ((_ELEMENT, "</"), (_ATTRIBUTES, "value=")):
        if mark in text:
            out += [(m["name"], [m.span("value")], None) for m in rule.finditer(text)]
    if ": |" in text or ": >" in text:
        out += [(m["name"].rstrip(".-"), [x.span() for x in _LINE.finditer(text, *m.span("value"))], None)
                for m in _BLOCK.finditer(text)]
    return out


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Places of the literals that reach a sensitive name and look like secrets."""
    if not any(c in text for c in "=:(<"):
        return []
    found = pairs(text)
    takes_from: dict[str, set[str]] = {}  # name -> names whose value it takes over
    for name, _, ref in found:
        if ref and ref != name:
            takes_from.setdefault(name, set()).add(ref)
    # Highest sensitivity among a name and all names its value flows into: the most sensitive names
    # hand theirs on first, so each name is visited once however long the chains are.
    best: dict[str, int] = {}
    names = {x for name, _, ref in found for x in (name, ref) if x is not None}
    for points, target in sorted(((name_score(x), x) for x in names), reverse=True):
        todo = [target]
        while todo:
            if (x := todo.pop()) not in best:
                best[x] = points
                todo += takes_from.get(x, ())
    spans = set()
    for name, parts, ref in found:
        if ref is None and (points := best[name]) >= 3:
            if points + literal_score("".join(text[s:e] for s, e in parts)) >= THRESHOLD:
                spans.update(parts)
    return sorted(spans)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain patterns."""
    out = []
    if "=" in text or ":" in text:
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``spans`` array<struct<kind, start, end>> in order of start, kind."""
    common.prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                spans = base_spans(text)
                spans += [(s, e, "literal") for s, e in literal_spans(text)]
                spans.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
                rows.append([{"kind": k, "start": s, "end": e} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, span_type)], ["doc_id", "spans"])

    return narrow.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = secret_scan(common.table(spark, sf_dir, "documents"))

    def joined(keep=None):
        spans = F.col("spans") if keep is None else F.filter("spans", keep)
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        n("literal").alias("n_literal"),
        F.sha2(joined(lambda s: s["kind"] != "literal").cast("binary"), 256).alias("base_sha256"),
        joined().alias("spans"))
