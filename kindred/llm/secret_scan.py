"""Secret scans: patterns, and strings that zstandard cannot explain from what is near.

Base spans are those of three patterns. The method adds ``novel`` spans: a run of 16 sign-free
characters or more, with what dots join to it, is a candidate if a sensitive word is at most
``WIDE`` characters before it, on whatever line, or if only line breaks, quotes and the like
part it from such a run, as in a key of many lines. Its surroundings and a
dictionary of common identifiers prime a zstandard compressor; what the candidate adds to the
compressed length, per character and in pieces too short for entropy coding, is its novelty. Names, paths, repeated strings and words
compress against the prime; keys do not. Candidates with letters and digits whose novelty is
``NOVELTY`` or more are reported, without what base spans already cover. If dots join a run
that is not novel as a whole, its long segments are candidates by themselves.

Two sorts of candidate need more than novelty, as matches of zstandard are too long to know a
plain word that it has not seen. One without digits must cost ``PLAIN`` bits a letter or more
by the letter pairs of its surroundings and of ``LANGUAGE``: words follow them, random letters
do not. One of 8 to 15 characters must be what a sensitive word is said to be (``password is …``,
``secret: …``), be no call, name or path, and have a letter behind a digit, or letters as above.

Spans count code points, the end is exclusive. A null text is empty and has no span. Long
texts are scanned whole; the prime is ``AROUND`` characters to either side of a candidate.

Each row is a text of its own, so repeated rows give repeated results; an empty table gives none.
Columns are taken by name and further ones stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import common

# The patterns, in the order of their kinds. Case only matters where ASCII has it.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "novel"]

# A text without any of these, lower-cased, has no assignment.
ASSIGN_WORDS = [b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"]
SENSITIVE_WORDS = [
    b"pass", b"pwd", b"secret", b"token", b"apikey", b"api_key", b"api-key", b"api key", b"credential",
    b"auth", b"bearer", b"private", b"access", b"signature", b"webhook", b"license",
]
# The words of the first group count at the end of longer ones too, as in ``dbpassword``.
SENSITIVE = re.compile(
    r"(password|passwd|passphrase|passcode|secret|token|credential|api[_ -]?key)|pass|pwd|authorization|auth|bearer"
    r"|private[_ -]?key|access[_ -]?key|signature|webhook|license[_ -]?key",
    re.I | re.A,
)
SEGMENT = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}", re.A)
JOINED = re.compile(r"(?:\.[A-Za-z0-9+/_=-]+)*", re.A)
BEFORE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-.")
# The parts of a run that is not novel as a whole, and a name with the sign of an assignment.
PART = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}", re.A)
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=+(?=[A-Za-z0-9+/_-]{16})", re.A)
# What is between the lines of one key, and the short last line of an armoured one.
BREAK = re.compile(r"""(?:\s|\\[nrt]|["'+,>#*\\-]){0,64}""")
LAST_LINE = re.compile(r"(?:\s|\\[nrt])+([A-Za-z0-9+/]{1,15}={0,2})(?=(?:\s|\\[nrt])*-----END)", re.A)
IDENTIFIERS = (
    "self return import from class function const static public private string int float bool null none true false "
    "password passwd secret token api_key apikey access_key private_key client_id client_secret bearer authorization "
    "username user_name email address config settings default value example placeholder changeme your_token_here "
    "https http www com org net html localhost 127.0.0.1 usr bin etc home var tmp index main test data file name "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx 00000000000000000000"
).encode()
# Words whose letter pairs stand for ordinary language next to those of a text.
LANGUAGE = (
    "the and that have with this from they would there their what about which when make like time just know take "
    "people into year your good some could them other than then only come over think also back after work first "
    "well even want because these give most between through another against under system program number different "
    "important information development government international application configuration management administration "
    "environment experience community university available following understanding communication responsibility "
    "organization performance particular individual themselves something technology relationship production "
    "knowledge background description authentication permission certificate repository directory template element "
    "object request response handler"
)
# What a sensitive word is said to be: at most four words, then a verb or a sign, then the value.
SAID = re.compile(
    r"""(?:[\x20_-][A-Za-z]{1,15}){0,4}?["'`)\]]?(?:\x20?(?:[:=]=?|[=-]>)|\x20(?:is|was|are|be|to|as|reads|equals)[:=]?)"""
    r"""[\x20"'`(\[]{1,4}(?![./]|v?[0-9]+[.][0-9])([A-Za-z0-9+/_=.!#$%^&*-]{8,})""",
    re.A,
)
MIXED = re.compile(r"[0-9][^A-Za-z]*[A-Za-z]")

AROUND = 1024
WIDE = 256
PIECE = 56  # zstandard entropy-codes literals from 64 bytes on
RECENT = 4096
EMPTY = len(zstandard.ZstdCompressor(level=9, write_content_size=False).compress(b""))  # bytes of a frame without content
NOVELTY = 0.8
PLAIN = 4.6  # bits a letter; letters drawn at random cost log2(26) = 4.7 or more
REPLACEMENT = "[SECRET]"


def novelty(candidate: str, before: str, after: str) -> float:
    """Compressed bytes that ``candidate`` adds, per byte, next to its surroundings.

    It is compressed in pieces of at most ``PIECE`` characters, each primed with what is
    before it, the earlier pieces too. So short an input is not entropy-coded: a random
    string costs its length whatever its alphabet is."""
    raw, added = candidate.encode(), 0
    prefix = IDENTIFIERS + b"\n" + after.encode() + b"\n"
    n = -(-len(raw) // PIECE)
    cuts = [len(raw) * k // n for k in range(n + 1)]
    before = before.encode()
    for at, end in zip(cuts, cuts[1:]):
        # Longer candidates see RECENT bytes of themselves, so that the work grows with the length.
        prime = prefix + (before + raw[:at] if at <= RECENT else raw[at - RECENT : at])
        compressor = zstandard.ZstdCompressor(
            level=9, dict_data=zstandard.ZstdCompressionDict(prime, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        added += len(compressor.compress(raw[at:end])) - EMPTY
    return added / len(raw)


def _pairs(text: str) -> np.ndarray:
    """The letter pairs of ``text`` as numbers below 676, whatever the case."""
    letters = np.frombuffer(text.lower().encode(), np.uint8).astype(np.int64) - ord("a")
    first, second = letters[:-1], letters[1:]
    return (26 * first + second)[(first >= 0) & (first < 26) & (second >= 0) & (second < 26)]


LANGUAGE_PAIRS = np.bincount(_pairs(LANGUAGE), minlength=676)


def letter_bits(candidate: str, around: str) -> float:
    """Bits per letter of ``candidate`` by the letter pairs of ``around`` and ``LANGUAGE``,
    whatever the case; 0 if no two letters are side by side."""
    pairs = _pairs(candidate)
    if not len(pairs):
        return 0.0
    seen = (LANGUAGE_PAIRS + np.bincount(_pairs(around), minlength=676)).reshape(26, 26) + 0.5
    return float(np.log2(seen.sum(1)[pairs // 26] / seen.ravel()[pairs]).mean())


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Sorted spans, overlapping ones together."""
    out = []
    for start, kind, end in spans:
        if out and start <= out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(out[-1][2], end))
        else:
            out.append((start, kind, end))
    return out


def _uncovered(start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of ``start:end`` that are in no base span."""
    out = []
    for s, _, e in base[bisect_left(base, start, key=lambda span: span[2]) :]:
        if s >= end:
            break
        if s > start:
            out.append((start, s))
        start = max(start, e)
    return [*out, (start, end)] if start < end else out


def _is_novel(text: str, start: int, end: int) -> bool:
    candidate = text[start:end]
    if end - start < 16 or not any(c.isalpha() for c in candidate):
        return False
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    if not any(c.isdigit() for c in candidate) and letter_bits(candidate, f"{before} {after}") < PLAIN:
        return False
    return novelty(candidate, before, after) >= NOVELTY


def _is_short_novel(text: str, start: int, end: int) -> bool:
    candidate = text[start:end]
    if not 8 <= end - start < 16 or text[end : end + 1] in tuple("([{<@:/\\"):
        return False
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    if not MIXED.search(candidate) and letter_bits(candidate, f"{before} {after}") < PLAIN:
        return False
    return novelty(candidate, before, after) >= NOVELTY


def _is_word(text: str, m: re.Match) -> bool:
    """Whether no word goes on before or after ``m``; another case begins another word, as
    in ``clientSecretKey``, and a plural is the same word."""
    start, end = m.span()
    before = text[start - 1 : start]
    if before.isascii() and before.isalpha() and not m.group(1):
        if not (text[start].isupper() and (before.islower() or text[start + 1].islower())):
            return False
    for at in (end, end + 1) if text[end : end + 1] in ("s", "S") else (end,):
        after = text[at : at + 1]
        if not (after.isascii() and after.isalpha()) or (after.isupper() and text[at - 1].islower()):
            return True
    return False


def _runs(text: str):
    """``(start, end)`` of every run with a long segment, with what dots join to it."""
    last = 0
    for m in SEGMENT.finditer(text):
        start = at = m.start()
        if start < last:
            continue
        while at > last and text[at - 1] in BEFORE and text[at - 1 : at + 1] != "..":
            at -= 1
            start = at if text[at] != "." else start
        last = JOINED.match(text, m.end()).end()
        yield start, last


def _novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    base = _merged(base)
    found = []
    word = last = -WIDE - 1  # the ends of the last sensitive word, and of the last run near one
    read = 0
    for start, end in _runs(text):
        named = NAME.match(text, start, end)
        read = max(read, start - WIDE)
        for m in SENSITIVE.finditer(text, read, named.end() if named else start):
            if _is_word(text, m):
                word = m.end()
            read = m.end()
        if named and word > start:
            start = named.end()
        if start - word > WIDE and not (0 <= last and start - last <= 64 and BREAK.fullmatch(text, last, start)):
            continue
        last = end
        for part in _uncovered(start, end, base):
            if _is_novel(text, *part):
                found.append((part[0], 3, part[1]))
                continue
            for m in PART.finditer(text, *part):
                if m.span() != part and _is_novel(text, *m.span()):
                    found.append((m.start(), 3, m.end()))
        tail = LAST_LINE.match(text, end)
        if tail and found and found[-1][2] == end and _uncovered(*tail.span(1), base) == [tail.span(1)]:
            found.append((tail.start(1), 3, tail.end(1)))
    return found


def _said_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Values of 8 to 15 characters that sensitive words are said to have, outside ``known``."""
    known = _merged(known)
    found, read = [], 0
    for m in SENSITIVE.finditer(text):
        said = SAID.match(text, m.end()) if _is_word(text, m) else None
        if said is None or said.start(1) < read:
            continue
        start, end = said.start(1), said.start(1) + len(said.group(1).rstrip(".!-"))
        if _uncovered(start, end, known) == [(start, end)] and _is_short_novel(text, start, end):
            found.append((start, 3, end))
            read = end
    return found


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of every span, in order."""
    found = []
    folded = text.encode().lower()
    if any(word in folded for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if b"akia" in folded:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(word in folded for word in SENSITIVE_WORDS):
        found += _novel_spans(text, sorted(found))
        found += _said_spans(text, sorted(found))
    return sorted(found)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


COUNTS = ["n_assign", "n_access", "n_hex", "n_novel"]
SCAN = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


@F.pandas_udf(SCAN)
def scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        found = spans_of(text or "")
        base = _joined(s for s in found if s[1] < 3)
        rows.append(
            (*(sum(k == kind for _, k, _ in found) for kind in range(4)),
             hashlib.sha256(base.encode()).hexdigest(), _joined(found))
        )
    return pd.DataFrame(rows, columns=SCAN.names)


def redact(text: str) -> str:
    """``text`` with every span, overlapping ones together, replaced by a marker."""
    out, at = [], 0
    for start, _, end in spans_of(text):
        if start >= at:
            out += [text[at:start], REPLACEMENT]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


@F.pandas_udf(T.StringType())
def redacted_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: text if text is None else redact(text))


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, the digest of the base spans, and all spans, per row."""
    found = common.texts(docs).select("doc_id", scan("text").alias("found"))
    return found.select("doc_id", "found.*")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all secrets in ``text`` replaced; all columns and rows are kept, and
    ``n_chars``, where there is one, is that of the new text."""
    out = docs.withColumn("text", redacted_text(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op3_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scanned(common.table(spark, sf_dir, "documents"))
