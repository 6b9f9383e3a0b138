"""Quality rules: line-first cleaning.

Each line is judged by itself: punctuation (symbol clutter, shouted marks), navigation (menus and
breadcrumbs) and boilerplate (notices, banners, calls to action). A boilerplate phrase, of any of the languages
given, counts by its share of the line: a sentence that happens to hold one stays. Failing lines are removed; a
document that loses too much of its text that way is rejected. Whole-text counts (words, symbols, repeated lines
and 8-word windows) are computed beside it and reject by themselves.

Scale: one pass over the input, no shuffle, memory bounded by a slice of text or one long text.

Defined results: a null text has no words, zero counts and fails (fewer than 20 words); an empty text
likewise. Repeated rows are judged each by itself.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A line may have this share of clutter among its visible bytes.
MAX_CLUTTER = 0.10
#: A document may lose this share of its visible bytes with the failing lines.
MAX_LOSS = 0.50

SYMBOLS = b"#*$%&|<>"
_CLUTTER = b"#*$%&|<>{}~^\\=_"
_BLANK = bytes(range(9, 14)) + b" "
_SEPARATOR = re.compile(rb"(?:^|(?<=\s))(?:\||>|>>|/|-|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7)(?=\s|$)")
#: Phrases of notices, banners and calls to action by language: lower case, words split by one space.
PHRASES = {
    "en": ("all rights reserved", "cookie policy", "cookie settings", "cookie preferences", "accept cookies", "accept all cookies",
           "use cookies", "uses cookies", "terms of use", "terms of service", "terms and conditions", "privacy policy",
           "enable javascript", "javascript is disabled", "lorem ipsum", "click here", "read more", "subscribe now", "subscribe to our",
           "sign in", "sign up", "log in", "login", "share this article", "share this page", "share on facebook", "share on twitter",
           "skip to content", "skip to main content", "back to top", "powered by", "copyright (c)", "copyright \u00a9", "\u00a9"),
    "de": ("alle rechte vorbehalten", "datenschutzerkl\u00e4rung", "cookie-einstellungen", "cookies akzeptieren",
           "alle cookies akzeptieren", "verwendet cookies", "verwenden cookies", "nutzungsbedingungen", "javascript aktivieren", "hier klicken",
           "klicken sie hier", "mehr lesen", "weiterlesen", "jetzt abonnieren", "newsletter abonnieren", "jetzt anmelden",
           "artikel teilen", "zum inhalt springen", "nach oben"),
    "fr": ("tous droits r\u00e9serv\u00e9s", "politique de confidentialit\u00e9", "param\u00e8tres des cookies",
           "accepter les cookies", "accepter tous les cookies", "utilise des cookies", "utilisons des cookies", "conditions d'utilisation",
           "mentions l\u00e9gales", "activer javascript", "cliquez ici", "en savoir plus", "lire la suite", "abonnez-vous",
           "partager cet article", "aller au contenu", "haut de page"),
    "es": ("todos los derechos reservados", "pol\u00edtica de privacidad", "pol\u00edtica de cookies", "configuraci\u00f3n de cookies",
           "aceptar cookies", "aceptar todas las cookies", "utiliza cookies", "utilizamos cookies", "t\u00e9rminos y condiciones",
           "aviso legal", "activar javascript", "haga clic aqu\u00ed", "haz clic aqu\u00ed", "leer m\u00e1s", "suscr\u00edbete",
           "iniciar sesi\u00f3n", "compartir este art\u00edculo", "saltar al contenido", "volver arriba"),
}
#: A line fails if phrases make up this share of its visible characters.
MIN_PHRASE_SHARE = 0.20


class Phrases:
    """Phrases of several languages: an automaton tells whether a text has any, a pattern what they cover
    (a sign like \u00a9 with the year after it)."""

    def __init__(self, by_language: dict[str, tuple[str, ...]], min_share: float = MIN_PHRASE_SHARE):
        phrases = sorted({p for ps in by_language.values() for p in ps}, key=lambda p: (-len(p), p))
        self.by_language, self.min_share = by_language, min_share
        self.any_of = ahocorasick.Automaton()
        for p in phrases:
            self.any_of.add_word(p, p)
        self.any_of.make_automaton()
        self.pattern = re.compile("|".join(
            (r"(?<!\w)" if p[0].isalnum() else "") + re.escape(p)
            + (r"(?!\w)" if p[-1].isalnum() else r"(?: ?\d{4}(?!\d))?") for p in phrases) or r"(?!)")

    def __reduce__(self):
        return Phrases, (self.by_language, self.min_share)

    def found(self, text: bytes) -> str | None:
        """The text in lower case with single spaces if it has a phrase (inside a word, too), else None."""
        if not len(self.any_of):
            return None
        low = " ".join(text.decode("utf-8").lower().split())
        return low if next(self.any_of.iter(low), None) else None

    def fill(self, line: bytes) -> bool:
        """Do phrases make up the share of the line?"""
        if (low := self.found(line)) is None:
            return False
        covered = sum(len(m[0].replace(" ", "")) for m in self.pattern.finditer(low))
        return covered > 0 and covered >= self.min_share * len(low.replace(" ", ""))


BOILERPLATE = Phrases(PHRASES)

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(_BLANK)] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_TO_SPACE = bytes(32 if b in _BLANK else b for b in range(256))


def line_fails(line: bytes, phrases: Phrases | None = BOILERPLATE) -> str | None:
    """Name of the first rule that a line breaks, or None. A line without words breaks none."""
    size = len(line.translate(None, _BLANK))
    if not size:
        return None
    clutter = size - len(line.translate(None, _BLANK + _CLUTTER))
    shouts = line.count(b"!") + line.count(b"?")
    if clutter > MAX_CLUTTER * size or shouts >= 3 and 2 * shouts > len(line.split()):
        marks = len(_SEPARATOR.findall(line))
        return "navigation" if marks >= 2 and clutter <= 2 * marks else "punctuation"
    if len(_SEPARATOR.findall(line)) >= 2 and 3 * len(_SEPARATOR.findall(line)) >= len(line.split()) - 1:
        return "navigation"
    if phrases and phrases.fill(line):
        return "boilerplate"
    return None


def clean_lines(text: bytes, phrases: Phrases | None = BOILERPLATE) -> tuple[bytes, int, int]:
    """(text without failing lines, visible bytes before, visible bytes lost)."""
    total = len(text.translate(None, _BLANK))
    # A text without any mark that a rule looks at has no failing line.
    phrases = phrases if phrases and phrases.found(text) is not None else None
    if not phrases and len(text) == len(text.translate(None, _CLUTTER + b"!?/-\xbb\xba\xa2\xb7")):
        return text, total, 0
    kept, lost = [], 0
    for line in text.split(b"\n"):
        if line_fails(line, phrases):
            lost += len(line.translate(None, _BLANK))
        else:
            kept.append(line)
    return (b"\n".join(kept) if lost else text), total, lost


def base_counts(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Word, symbol, repeated-line and repeated-window counts of each text of a slice."""
    n = len(texts)
    blob = b" ".join(t or b"" for t in texts)
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:n]
    data = np.frombuffer(blob.translate(_TO_SPACE), np.uint8)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[begin + sizes] - sums[begin]

    starts, ends = common.word_spans(data)
    of = np.searchsorted(begin, starts, "right") - 1
    n_words = np.bincount(of, minlength=n).astype(np.int64)
    repeat = np.zeros(n, np.int64)
    if len(starts) >= WINDOW:
        word = common.mix(common.Prefix(data).raw(starts, ends))
        win = common.windows(word, WINDOW)
        inside = of[WINDOW - 1:] == of[:len(win)]
        at = np.flatnonzero(inside)
        # equal windows of different texts are told apart by the text's number
        key = common.mix(win[at] + of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        step = np.zeros(len(starts) + 1, np.int64)
        twice = at[times[back] > 1]
        np.add.at(step, twice, 1)
        np.add.at(step, twice + WINDOW, -1)
        repeat = np.bincount(of[np.cumsum(step)[:-1] > 0], minlength=n).astype(np.int64)
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        if t and b"\n" in t:
            lines = [x for x in t.split(b"\n") if x and not x.isspace()]
            dup[i] = len(lines) - len(set(lines))
    raw = np.frombuffer(blob, np.uint8)
    return {"n_words": n_words, "word_chars": per_text(((raw & 0xC0) != 0x80) & ~_IS_BLANK[raw]),
            "n_symbols": per_text(_IS_SYMBOL[raw]), "n_dup_lines": dup, "n_repeat_words": repeat}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Phrases | None = BOILERPLATE) -> DataFrame:
    """One row per input row: id, the counts, visible bytes before and lost, ``base_failed``, ``kept``
    and ``clean_text`` (the text without failing lines; null stays null)."""
    common.prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType
    id_type = pa.schema([pa.field("doc_id", _arrow_type(kind))]).field(0).type

    def run(batches):
        for (ids,), texts in common.slices(batches, 1):
            counts = base_counts(texts)
            cleaned = [clean_lines(t, phrases) if t is not None else (None, 0, 0) for t in texts]
            failed = ((counts["n_words"] < MIN_WORDS)
                      | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]))
            total = np.array([c[1] for c in cleaned], np.int64)
            lost = np.array([c[2] for c in cleaned], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), *(pa.array(counts[c], pa.int64()) for c in COUNTS),
                 pa.array(total), pa.array(lost), pa.array(failed),
                 pa.array(~failed & (lost <= MAX_LOSS * total)),
                 pa.array([None if c[0] is None else c[0].decode("utf-8") for c in cleaned], pa.string())],
                ["doc_id", *COUNTS, "n_bytes", "n_lost", "base_failed", "kept", "clean_text"])

    return narrow.mapInArrow(run, f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
                             + ", n_bytes long, n_lost long, base_failed boolean, kept boolean, clean_text string")


def _arrow_type(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def apply_quality(docs: DataFrame, text_col: str = "text", phrases: Phrases | None = BOILERPLATE) -> DataFrame:
    """The input's rows that are kept, all columns, with their failing lines removed.

    ``n_chars`` (if the input has it) is the length of the text that stays.
    """
    common.prepare(docs.sparkSession)
    cols, at = docs.columns, docs.columns.index(text_col)
    size_at = cols.index("n_chars") if "n_chars" in cols else None
    frame = docs.select(*cols)

    def run(batches):
        for batch in batches:
            keep, texts = [], []
            lo = 0
            for _, part in common.slices([batch.select([text_col])], 0):
                counts = base_counts(part)
                for i, t in enumerate(part):
                    words = int(counts["n_words"][i])
                    if words < MIN_WORDS or 100 * int(counts["n_repeat_words"][i]) > MAX_REPEAT_PERCENT * words:
                        continue
                    text, total, lost = clean_lines(t, phrases)
                    if lost <= MAX_LOSS * total:
                        keep.append(lo + i)
                        texts.append(text.decode("utf-8"))
                lo += len(part)
            out = batch.take(pa.array(keep, pa.int64()))
            arrays = [out.column(i) for i in range(len(cols))]
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            if size_at is not None:
                arrays[size_at] = pa.array([len(t) for t in texts], pa.int64()).cast(batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(arrays, cols)

    return frame.mapInArrow(run, frame.schema)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(common.table(spark, sf_dir, "documents")).drop("clean_text", "n_bytes", "n_lost")
