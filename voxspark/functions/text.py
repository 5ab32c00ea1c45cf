"""Transcript cleaning, punctuation-free normalisation and word distance as Column
expressions (SCL1-SCL13).  NFKC and the word distance run in Arrow
UDFs; everything else stays inside whole-stage codegen.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Transcript clean-up: literal replacements applied in this order (SCL1).
CLEAN_REPLACEMENTS = [
    ("(", ""),
    (")", ""),
    (" .", "."),
    ("«", ""),
    ("»", ""),
    ("'", ""),
    (" ,", ","),
    (" :", ":"),
    (" ;", ";"),
    (" !", "!"),
    (" ?", "?"),
    ("  ", " "),
    ("“", '"'),
    ("”", '"'),
    ("„", '"'),
]
# Characters deleted before WER (ASCII punctuation plus these extra marks) (SCL10).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
EXTRA_PUNCTUATION = "—–…«»„\"'"
# The same set as a regex, a character each: those below U+0100 are one bit test.
PUNCTUATION_CLASS = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in dict.fromkeys(ASCII_PUNCTUATION + EXTRA_PUNCTUATION)) + "]+"
# White space as Python's str.split()/str.strip() see it (includes U+001C-U+001F).
WHITESPACE_CHARS = ("\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
                    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                    "\u2028\u2029\u202f\u205f\u3000")
# WER bands: (strictly greater than, label); anything not above 0.15 is "low" (SCL13).
WER_BANDS = [(1.0, "critical"), (0.5, "very high"), (0.3, "high"), (0.15, "medium")]
# ---------------------------------------------------------------------------

# Java regex character class for the white space above.
WS_CLASS = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
            "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
# The same set by the Unicode property, which is one table lookup a character.
WS_FAST = "(?U)[\\s\\x1C-\\x1F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_chars(c) -> Column:
    """SCL1: ordered literal replacements."""
    c = _col(c)
    for a, b in CLEAN_REPLACEMENTS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def py_strip(c) -> Column:
    """SCL2: strip Unicode white space at both ends (Python ``str.strip``)."""
    return F.regexp_replace(_col(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def squeeze_ws(c) -> Column:
    """``' '.join(s.split())``: runs of white space -> one space, ends stripped."""
    return F.trim(F.regexp_replace(_col(c), f"{WS_FAST}+", " "))


def fix_ellipsis(c) -> Column:
    """SCL3-SCL5: unicode ellipsis, two-dot runs, '?..'/'!..'."""
    c = F.replace(_col(c), F.lit("…"), F.lit("..."))
    c = F.regexp_replace(c, r"(?<![.])\.\.(?!\.)", "...")
    return F.regexp_replace(c, r"([?!])\.\.(?!\.)", "$1...")


def fix_quotes(c) -> Column:
    """SCL6-SCL7: squeeze runs of '"', then drop the last one if the count is odd."""
    c = F.regexp_replace(_col(c), '"{2,}', '"')
    n_quotes = F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))
    return F.when(n_quotes % 2 == 1, F.regexp_replace(c, '"(?=[^"]*\\z)', "")).otherwise(c)


def clean_text(c) -> Column:
    """SCL8: full transcript normaliser (SCL1 -> SCL7)."""
    return fix_quotes(fix_ellipsis(py_strip(clean_chars(c))))


SLICE = 1 << 21             # bytes of text that a worker takes out of a batch at a time


def _slices(*columns: pa.Array):
    """(start, rows) of a batch's rows by ``SLICE`` bytes of these columns' texts, a longer row alone."""
    ends = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy().astype("int64") for c in columns).cumsum()
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(int(ends.searchsorted(done + SLICE, "right")), start + 1)
        yield start, stop - start
        start = stop


@F.arrow_udf(T.StringType())
def _nfkc_udf(s: pa.Array) -> pa.Array:
    parts, same = [], True
    for start, n in _slices(s):
        part = s.slice(start, n)
        if pc.string_is_ascii(part).false_count:
            was = part.to_pylist()
            now = [x and unicodedata.normalize("NFKC", x) for x in was]
            if now != was:
                part, same = pa.array(now, s.type), False
        parts.append(part)
    return s if same else pa.concat_arrays(parts)


@functools.lru_cache(maxsize=None)
def nfkc_unstable_chars() -> str:
    """Every character NFKC can change or use: characters whose own NFKC differs,
    combining marks (reordering), second halves of canonical pairs and Hangul vowel /
    trailing jamo (composition).  A string holding none of them is already NFKC.
    Derived from the running Python's Unicode tables."""
    bad = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch) or unicodedata.normalize("NFKC", ch) != ch:
            bad.add(cp)
        d = unicodedata.decomposition(ch)
        if d and not d.startswith("<") and len(d.split()) == 2:
            bad.add(int(d.split()[1], 16))
    return "".join(chr(cp) for cp in sorted(bad))


def needs_nfkc(c) -> Column:
    """True when the text holds a character NFKC can change: ``translate`` deletes
    those characters (one hash lookup per character; a regex class of this size would
    test hundreds of ranges per character).  ASCII never changes, so only the other
    characters of a text are looked up."""
    c = _col(c)
    rest = F.regexp_replace(c, "[\\x00-\\x7F]+", "")
    return F.when(F.octet_length(c) == F.length(c), False).otherwise(
        F.length(F.translate(rest, nfkc_unstable_chars(), "")) != F.length(rest))


def nfkc(c) -> Column:
    """SCL9: NFKC.  Spark has no built-in, so an Arrow UDF takes every row once: its argument
    is the only use of ``c``, which would otherwise be computed for the check and for the
    result.  ASCII rows pass through; Python's own quick check spares most others."""
    return _nfkc_udf(_col(c))


def bare(c, unicode_normalize: bool = True) -> Column:
    c = _col(c)
    if unicode_normalize:
        c = nfkc(c)
    return F.lower(F.regexp_replace(c, PUNCTUATION_CLASS, ""))


def no_punct(c, unicode_normalize: bool = True) -> Column:
    """SCL10: NFKC, delete punctuation, lower-case, squeeze white space; null -> ''."""
    return F.coalesce(squeeze_ws(bare(c, unicode_normalize)), F.lit(""))


def no_punct_words(c) -> Column:
    """``words(no_punct(c))``, split at white space at once instead of squeezing it first."""
    return raw_words(bare(c))


def words(c) -> Column:
    """SCL11: white-space words of a squeezed string; '' -> []."""
    return F.array_remove(F.split(_col(c), " "), "")


def raw_words(c) -> Column:
    """Words of an unnormalised string (Python ``str.split()``); null -> []."""
    return F.array_remove(F.split(F.coalesce(_col(c), F.lit("")), f"{WS_FAST}+"), "")


LANES = 1 << 24             # bytes of masks that pairs worked on together may take
STEPS = 128                 # columns of their tables between choices of rows


def _masks(x: np.ndarray, y: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """A row for each word of both with the bits of its places in ``x``, as bytes with a bit to spare, and a
    last row of none; the row of every word of ``y``; the least edits that the words' counts
    allow.  ``last`` is -1 at every word's number."""
    size, places = len(x) // 8 + 1, np.arange(len(x))
    last[x] = places
    same, found = last[x], last[y]
    last[x] = -1
    wanted = np.zeros(len(x), bool)
    wanted[found[found >= 0]] = True
    row = np.cumsum(wanted) - 1
    none = int(row[-1]) + 1
    table = np.zeros((none + 1) * size, np.uint8)
    at_x, at_y = np.where(wanted[same], row[same], none), np.where(found < 0, none, row[found])
    np.add.at(table, at_x * size + (places >> 3), np.left_shift(1, places & 7).astype(np.uint8))
    table[none * size:] = 0
    both = np.minimum(*(np.bincount(at, minlength=none + 1) for at in (at_x, at_y)))[:none].sum()
    return table.reshape(-1, size), at_y, max(len(x), len(y)) - int(both)


def _abreast(sides: list[tuple[int, np.ndarray, np.ndarray, int]]) -> list[int]:
    """Distances of several pairs, as ``(len(x), table, rows, most)`` by falling ``len(y)``; one over its ``most``
    is an upper bound.  A column of a distance table is two integers, a bit a row, that hold where
    it rises and where it falls (Myers 1999, Hyyro 2003); the pairs lie side by side in them, a
    spare bit taking each one's carry.  Only ``up`` is cleared of spare bits at each step: those of
    the others reach no other pair.  A way of ``most`` edits stays near the diagonal (Ukkonen 1985),
    so every ``STEPS`` columns the bytes of rows are chosen anew: rows above them, and rows that
    come in below, count as rising by one a step, which no distance exceeds."""
    out, live, step = [0] * len(sides), len(sides), 0
    kept, over = [(0, b"", b"")] * live, [0] * live
    while live:
        steps = min(len(sides[0][2]) - step, STEPS)
        starts, fulls = [0], []
        for k, (n, table, rows, most) in enumerate(sides[:live]):
            first, up, down = kept[k]
            begin = max(0, step - 1 + (n - len(rows) - most) // 2) // 8
            end = min(n // 8, (step + steps + 1 + (n - len(rows) + most) // 2) // 8) + 1
            if gone := begin - first:
                over[k] += int.from_bytes(up[:gone], "little").bit_count() - int.from_bytes(down[:gone], "little").bit_count()
            whole = b"\xff" * (end - begin) if end <= n // 8 else b"\xff" * (end - begin - 1) + bytes([(1 << n % 8) - 1])
            kept[k] = begin, up[gone:] + whole[len(up) - gone:], down[gone:] + bytes(len(whole) - len(down) + gone)
            fulls.append(whole + bytes(end <= n // 8))
            starts.append(starts[-1] + len(fulls[-1]))
        masks = np.zeros((steps, starts[-1]), np.uint8)
        for start, (begin, up, _), (_, table, rows, _) in zip(starts, kept, sides[:live]):
            some = rows[step:step + steps]
            masks[:len(some), start:start + len(up)] = table[some, begin:begin + len(up)]
        masks = masks.tobytes()
        full = int.from_bytes(b"".join(fulls), "little")
        ones = int.from_bytes(b"".join(b"\1" + bytes(len(x) - 1) for x in fulls), "little")
        up, down = (int.from_bytes(b"".join(x[way].ljust(len(y), b"\0") for x, y in zip(kept, fulls)), "little") for way in (1, 2))
        for at in range(0, len(masks), starts[-1]):
            same = int.from_bytes(masks[at:at + starts[-1]], "little")
            across = (((same & up) + up) ^ up) | same | down
            rise = (down | (full ^ (across | up))) << 1 | ones
            up = ((up & across) << 1 | (full ^ (across | rise))) & full
            down = rise & across
            step += 1
            if len(sides[live - 1][2]) == step:
                while live and len(sides[live - 1][2]) == step:
                    live -= 1
                    offset = 8 * starts[live]
                    out[live] = step + over[live] + (up >> offset).bit_count() - ((down & full) >> offset).bit_count()
                    left = (1 << offset) - 1
                    up, down, full, ones = up & left, down & left, full & left, ones & left
        ups, downs = (x.to_bytes(starts[live], "little") for x in (up, down & full))
        kept = [(begin, ups[start:start + len(x)], downs[start:start + len(x)]) for start, (begin, x, _) in zip(starts, kept[:live])]
    return out


def _edits(pairs: list[tuple]) -> list[int]:
    """Levenshtein distance of each pair of lists of numbers; pairs of like length are worked on together,
    first for somewhat more edits than their words' counts ask for.  Those that take more have then
    got an upper bound, for which they are worked on again."""
    pairs = [(np.asarray(x, np.int32), np.asarray(y, np.int32)) for x, y in pairs]
    out = [len(x) + len(y) for x, y in pairs]
    last = np.full(1 + max((int(z.max()) for pair in pairs for z in pair if len(z)), default=0), -1)
    group, sides, used, bounds = [], [], 0, {}

    def close() -> None:
        for k, d, (*_, most) in zip(group, _abreast(sides), sides):
            out[k] = d
            if d > most:
                bounds[k] = d
        group.clear()
        sides.clear()

    todo = [k for k, (x, y) in enumerate(pairs) if len(x) and len(y)]
    while todo:
        before, bounds = bounds, {}
        for k in sorted(todo, key=lambda k: -len(pairs[k][1])):
            x, y = pairs[k]
            table, rows, least = _masks(x, y, last)
            if used + table.nbytes + rows.nbytes > LANES and group:
                close()
                used = 0
            group.append(k)
            sides.append((len(x), table, rows, before.get(k, least + least // 3 + 16)))
            used += table.nbytes + rows.nbytes
        close()
        todo, used = list(bounds), 0
    return out


def _distances(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[int]:
    """Edits of each pair of numbered words; the common start and end go first: they cost no edits."""
    rest = []
    for x, y in pairs:
        for way in (1, -1):
            least = min(len(x), len(y))
            same = np.append(x[::way][:least] == y[::way][:least], False).argmin()
            x, y = x[::way][same:][::way], y[::way][same:][::way]
        rest.append((x, y))
    return _edits(rest)


@F.arrow_udf(T.LongType())
def _word_edits(a: pa.Array, b: pa.Array) -> pa.Array:
    """Edits of each pair of word arrays.  Some rows at a time get numbers for their words."""
    out: list = []
    for k in range(0, len(a), 512):
        sides = a.slice(k, 512), b.slice(k, 512)
        codes = pa.concat_arrays([x.flatten() for x in sides]).dictionary_encode("encode").indices.to_numpy()
        n, m = (pc.list_value_length(x).to_pylist() for x in sides)
        at_x, at_y = 0, sum(v or 0 for v in n)
        pairs = []
        for nx, ny in zip(n, m):
            pairs.append((codes[at_x:at_x + (nx or 0)], codes[at_y:at_y + (ny or 0)]))
            at_x, at_y = at_x + (nx or 0), at_y + (ny or 0)
        out += [None if nx is None or ny is None else d for nx, ny, d in zip(n, m, _distances(pairs))]
    return pa.array(out, pa.int64())


def word_distance(a, b) -> Column:
    """SCL12: word-level Levenshtein (unit costs) of two word arrays; an empty side
    gives the other's length, a null side null.

    Each pair is a row's own work in Arrow batches: n words against m take n steps on
    integers of m bits.  Inputs must not themselves be Python UDF results inside a
    lambda; pass columns."""
    return _word_edits(_col(a), _col(b))


@F.arrow_udf(T.StructType().add("edits", T.LongType()).add("words", T.LongType()))
def _text_edits(a: pa.Array, b: pa.Array) -> pa.Array:
    edits, words = [], []
    for start, n in _slices(a, b):
        sides = [pc.utf8_split_whitespace(pc.fill_null(c.slice(start, n), "")) for c in (a, b)]
        found = pa.concat_arrays([x.flatten() for x in sides]).dictionary_encode()
        codes, empty = found.indices.to_numpy(), found.dictionary.index("").as_py()
        texts = np.split(codes, np.cumsum(np.concatenate([pc.list_value_length(x).to_numpy() for x in sides]))[:-1])
        texts = [t[t != empty] for t in texts]      # white space at an end leaves empty words
        words += map(len, texts[n:])
        edits += _distances([*zip(texts[:n], texts[n:])])
    return pa.StructArray.from_arrays([pa.array(edits, pa.int64()), pa.array(words, pa.int64())], ["edits", "words"])


def text_distance(a, b) -> Column:
    """``word_distance`` of the ``raw_words`` of two texts and the number of words of the second, as
    a struct of ``edits`` and ``words``.  Texts are split where the distance is taken, ``SLICE``
    bytes at a time: batches, and the rows that wait for their results, hold plain texts, a
    third of the size of arrays of their words."""
    return _text_edits(_col(a), _col(b))


def wer_band(c) -> Column:
    """SCL13: band label of a WER value (strict '>' thresholds; inf first)."""
    c = _col(c)
    out = F.when(c == float("inf"), F.lit("inf"))
    for lim, label in WER_BANDS:
        out = out.when(c > lim, F.lit(label))
    return out.otherwise(F.lit("low"))


def wer_text(c) -> Column:
    """SCL13: ``"%.4f (%.1f%%)"`` rendering (inf -> 'inf')."""
    c = _col(c)
    return F.when(c == float("inf"), F.lit("inf")).otherwise(
        F.format_string("%.4f (%.1f%%)", F.bround(c, 4), F.bround(c * 100, 1)))
