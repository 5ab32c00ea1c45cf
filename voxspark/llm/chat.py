"""Chat formatting by schema fingerprints.

Each record is a JSON object.  The set of its nested field paths is hashed to a
fingerprint; a table of declarative mappings, keyed by fingerprint, says where the roles
and texts of its turns stand.  One mapping covers a layout with any of its optional
fields.  The canonical turns are then written with a template that marks turns and
escapes control strings inside texts reversibly, and carries a loss mask.

Work is per turn row: no conversation is gathered into one value.  Reading back streams
rows sorted by conversation and turn, with the state of one conversation at a time.

Defined results: null or missing text and role count as empty; a record of no known
layout, or no JSON object, keeps one row with ``layout`` null and no turn; repeated turn
numbers are ordered by role, then text; null ids form one conversation of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values of the template
TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
CONTROLS = (r"\|turn\|>", r"\|text\|>", r"/?s>", r"/?INST\]", r"</?SYS>>")

ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where turns stand.  ``items``: path of the list of turns, with the keys of role and
    text; ``turns``: fixed (role, key) pairs in order; both may be given.  ``joined``:
    keys whose texts make one turn, separated by a blank line."""
    name: str
    required: tuple
    optional: tuple = ()
    turns: tuple = ()
    items: str | None = None
    role: str = "role"
    text: str = "content"
    joined: tuple = ()


LAYOUTS = (
    Layout("turn", ("role",), ("text",), items="", role="role", text="text"),
    Layout("turn", ("text",), (), items="", role="role", text="text"),
    Layout("turn", (), (), items="", role="role", text="text"),
    Layout("messages", ("messages[].content",), ("messages[].role", "messages[].name"), items="messages"),
    Layout("messages", ("messages",), ("system",), items="messages", turns=(("system", "system"),)),
    Layout("shares", ("conversations[].from", "conversations[].value"), ("system", "id"), items="conversations",
           role="from", text="value", turns=(("system", "system"),)),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           turns=(("system", "system"), ("user", "instruction"), ("assistant", "output")), joined=("instruction", "input")),
    Layout("prompt", ("prompt", "completion"), ("system",),
           turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt", ("prompt", "response"), ("system",),
           turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question", ("question", "answer"), ("context",),
           turns=(("user", "question"), ("assistant", "answer")), joined=("context", "question")),
    Layout("choice", ("prompt", "chosen", "rejected"), (), turns=(("user", "prompt"), ("assistant", "chosen"))),
)


def field_paths(value, at: str = "") -> set[str]:
    """Leaf paths of a JSON value; list levels are written ``[]``; an empty container is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {at} if at else set()


def fingerprint(paths) -> int:
    """Signed 64-bit hash of a set of paths."""
    return int.from_bytes(hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).digest(), "big", signed=True)


def mappings(layouts=LAYOUTS) -> dict[int, Layout]:
    """Fingerprint -> layout, for every choice of a layout's optional fields."""
    out: dict = {}
    for x in layouts:
        for n in range(len(x.optional) + 1):
            for some in combinations(x.optional, n):
                out.setdefault(fingerprint(x.required + some), x)
    return out


def _text(v) -> str:
    return "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def turns_of(record, table: dict[int, Layout]) -> tuple[int, str | None, list[tuple[str, str]]]:
    """(fingerprint, layout name, turns) of one parsed record."""
    mark = fingerprint(field_paths(record)) if isinstance(record, dict) else 0
    x = table.get(mark) if isinstance(record, dict) else None
    if x is None:
        return mark, None, []
    out = []
    for role, key in x.turns:
        keys = x.joined if key in x.joined else (key,)
        if any(k in record for k in keys):
            out.append((role, "\n\n".join(t for t in (_text(record.get(k)) for k in keys) if t or len(keys) == 1)))
    if x.items is not None:
        for it in [record] if x.items == "" else record[x.items]:
            role = _text(it.get(x.role)) if isinstance(it, dict) else ""
            out.append((ROLES.get(role, role), _text(it.get(x.text)) if isinstance(it, dict) else _text(it)))
    return mark, x.name, out


def canonical_turns(df: DataFrame, id_col: str, turn_col: str | None, payload_col: str, layouts=LAYOUTS) -> DataFrame:
    """``(conv_id, turn, part, role, text, layout, fingerprint)``: one row per turn of every
    record.  ``turn_col`` orders several records of a conversation; ``part`` counts the
    turns inside a record."""
    src = df.select(F.col(id_col).cast("long").alias("conv_id"),
                    (F.col(turn_col).cast("long") if turn_col else F.lit(0).cast("long")).alias("turn"),
                    F.col(payload_col).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = mappings(layouts)
        for b in batches:
            rows = []
            for conv, turn, payload in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    record = json.loads(payload) if payload is not None else None
                except ValueError:
                    record = None
                mark, name, turns = turns_of(record, table)
                rows += [(conv, turn, i, r, t, name, mark) for i, (r, t) in enumerate(turns)] or \
                    [(conv, turn, 0, None, None, name, mark)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
            names = ["conv_id", "turn", "part", "role", "text", "layout", "fingerprint"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return src.mapInArrow(run, "conv_id long, turn long, part long, role string, text string, layout string, fingerprint long")


_ESCAPE = r"([<\[])(\\*)(" + "|".join(CONTROLS) + ")"
_UNESCAPE = r"([<\[])\\(\\*)(" + "|".join(CONTROLS) + ")"


def escaped(c: Column) -> Column:
    """A backslash goes into every control string after its first character (one more, if
    there are some already), so that none stands in the result and nothing else changes."""
    return F.regexp_replace(c, _ESCAPE, r"$1\\$2$3")


def unescape(s: str) -> str:
    return re.sub(_UNESCAPE, r"\1\2\3", s)


def formatted(turns: DataFrame) -> DataFrame:
    """``turns`` with ``formatted`` (a conversation's text is the concatenation in the order of
    turn, part, role and text) and ``loss_start``, ``loss_end``: code points of ``formatted``
    under the loss mask, null but for assistant turns."""
    known = turns.where(F.col("layout").isNotNull())
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN), escaped(role), F.lit(TEXT))
    body = escaped(text)
    mine = role == "assistant"
    return known.select("*", F.concat(head, body, F.lit(END)).alias("formatted"),
                        F.when(mine, F.length(head)).alias("loss_start"),
                        F.when(mine, F.length(head) + F.length(body)).alias("loss_end"))


_PIECE = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.S)


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text and its mask alone: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.  Rows are dealt by conversation and sorted, so
    a task holds one row and the running digests of one conversation."""
    src = (pieces.select("conv_id", "turn", "part", F.coalesce("role", F.lit("")).alias("role"), "formatted",
                         "loss_start", "loss_end")
           .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "role", "formatted")
           .select("conv_id", "formatted", "loss_start", "loss_end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, state = None, None

        def end():
            if state is not None:
                n, turns, loss_n, loss, chars = state
                done.append((now[0], n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

        def out():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
            done.clear()
            return got

        for b in batches:
            for conv, s, lo, hi in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or now != (conv,):
                    end()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for m in _PIECE.finditer(s):
                    state[0] += 1
                    state[1].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                if lo is not None:
                    text = unescape(s[lo:hi])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(s)
            if len(done) >= 4096:
                yield out()
        end()
        if done:
            yield out()

    return src.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                               "formatted_chars long")
