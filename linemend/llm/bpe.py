"""Operator 1: byte-level BPE encoding and decoding by a tokenisation automaton.

The merge list is compiled into a deterministic automaton whose arcs carry
tokens and whose accepted paths are exactly the canonical BPE sequences.  It
starts as one state with an arc for each byte.  Merge number k, ``a + b -> c``,
applies one gadget: the state reached by ``a`` is split off and loses its arc
``b``, and every state that then has the path ``a b`` gains an arc ``c`` to a
copy of ``b``'s state as it stands at that moment.  Hence a state is named by
the last token read, and what it lacks is known from when things were made:

* a copy made at merge j keeps the losses of the original from before j;
* an arc made at merge j is missing wherever the arc of its left part was
  missing at j, or goes at j itself (``a + a``: the leftmost pair merges first).

So the gadget ``(y, b)`` number k takes from every state with y on its right spine
(made there after k) the arc b and the arcs with b on their left spine (made there at
k or later).  Tokens are ordered so that these are neighbours: after the tree of left
parts, children by the merge that makes them, parents last.  One gadget then takes one
interval of arcs, and a state's row of the transition table is a short ascending list of
interval bounds; states with equal rows share one.  The driver compiles the
table once (2.5 MB for 50,000 merges) and broadcasts it as flat arrays; a transition is
one binary search in a row.

A word is encoded by running its arcs against the table: longest arc first, falling back
from positions that turn out dead; each prefix has one accepted path only, so a dead
position is never tried twice and the run is linear in the word.  Decoding emits the arc
labels (bytes).

Results: a null text counts as empty; a text without tokens has no ids; extra
columns are not carried; rows are not merged (repeated rows give repeated rows).
"""

from __future__ import annotations

import hashlib
import json
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import file_bytes, lean, once, small_batches, table, tokenizer_file

# Fixed value: the pre-token pattern of byte-level BPE vocabularies of this family.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a worker keeps of encoded words, and the longest word kept.
WORD_CACHE, LONGEST_KEPT, HEAD = 200_000, 48, 4
BASE, NEVER = -1, 1 << 60
ROWS_OUT = 256


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: bytes
    that print as themselves do, the others take U+0100 onwards in byte order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {chr(b if b in plain else next(spare)): b for b in range(256)}


@dataclass
class Compiled:
    """The automaton as flat arrays.  ``labels`` and ``ends``: the labels of all tokens,
    one after the other; ``alive``: tokens that are arcs; ``place``: their order; a state's
    row is ``bounds[starts[row[state]] : starts[row[state] + 1]]``."""

    labels: bytes
    ends: array
    alive: bytes
    place: array
    row: array
    starts: array
    bounds: array


def compiled(vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> Compiled:
    """Applies the merge gadgets one after the other and lays the table out."""
    size = max(vocab.values(), default=-1) + 1
    made, parts = [BASE] * size, [None] * size
    gadgets: list[list[tuple[int, int]]] = [[] for _ in range(size)]  # by state: (merge, arc)
    number: dict[int, int] = {}
    children: list[list[int]] = [[] for _ in range(size)]  # by left part, in order of the merges
    alive = bytearray(size)
    for label, t in vocab.items():
        alive[t] = len(label) == 1

    def spine(token: int, side: int) -> Iterator[tuple[int, int]]:
        """(node, merge that made the node above it) down one side."""
        above = NEVER
        while True:
            yield token, above
            if parts[token] is None:
                return
            above, token = made[token], parts[token][side]

    def has(state: int, arc: int) -> bool:
        return not any((k := number.get(y * size + b, NEVER)) < since and k <= until for y, since in spine(state, 1) for b, until in spine(arc, 0))

    for k, (x, y) in enumerate(merges):
        a, b, c = vocab[x], vocab[y], vocab[x + y]
        if parts[c] is not None or c in (a, b):
            continue
        alive[c] |= alive[a] and alive[b] and has(a, b)  # else the path a b is gone, and no arc c arises
        if number.setdefault(a * size + b, k) == k:
            gadgets[a].append((k, b))
        parts[c], made[c] = (a, b), k
        children[a].append(c)

    place, first, at = array("I", bytes(4 * size)), [0] * size, 0
    for root in range(size):
        stack = [(root, 0)] if parts[root] is None else []
        while stack:
            t, i = stack.pop()
            if i == 0:
                first[t] = at
            if i < len(children[t]):
                stack += [(t, i + 1), (children[t][i], 0)]
            else:
                place[t] = at
                at += 1

    def interval(b: int, k: int) -> tuple[int, int]:
        late = bisect_left(children[b], k, key=made.__getitem__)
        return first[children[b][late]] if late < len(children[b]) else place[b], place[b] + 1

    taken = [[(k, *interval(b, k)) for k, b in own] for own in gadgets]
    rows: dict[bytes, int] = {}
    row, starts, bounds = array("I", bytes(4 * size)), array("I", [0]), array("I")
    for t in range(size):
        found = sorted((low, high) for y, since in spine(t, 1) for k, low, high in taken[y] if k < since)
        out = array("I")
        for low, high in found:
            if out and low <= out[-1]:
                out[-1] = max(high, out[-1])
            else:
                out.extend((low, high))
        key = out.tobytes()
        if key not in rows:
            rows[key] = len(rows)
            bounds.extend(out)
            starts.append(len(bounds))
        row[t] = rows[key]
    labels = [b""] * size
    for label, t in vocab.items():
        labels[t] = label
    return Compiled(b"".join(labels), array("I", accumulate(map(len, labels))), bytes(alive), place, row, starts, bounds)


class MergeAutomaton:
    """Runs a compiled automaton: states and arcs are token ids."""

    def __init__(self, table: Compiled):
        self.labels = [table.labels[a:b] for a, b in zip([0, *table.ends], table.ends, strict=False)]
        self._place, self._row, self._starts, self._bounds = table.place, table.row, table.starts, table.bounds
        self._token = {x: t for t, x in enumerate(self.labels) if table.alive[t]}
        heads: dict[bytes, set[int]] = {}
        for x in self._token:
            heads.setdefault(x[:HEAD], set()).add(len(x))
            for k in range(1, min(HEAD, len(x))):
                heads.setdefault(x[:k], set())
        #: By the bytes at a position, as many as some label begins with but at most HEAD: the
        #: lengths of the labels that may stand there, longest first.
        self._lengths = {x: tuple(sorted(n | {k for k in range(1, len(x) + 1) if x[:k] in self._token}, reverse=True)) for x, n in heads.items()}

    def _at(self, word: bytes, at: int) -> tuple[int, ...]:
        get = self._lengths.get
        for k in range(HEAD, 0, -1):
            if (found := get(word[at : at + k])) is not None:
                return found
        return ()

    def step(self, state: int, arc: int) -> bool:
        """Whether the state reached by token ``state`` has the arc ``arc``."""
        row, starts = self._row[state], self._starts
        low = starts[row]
        return not (bisect_right(self._bounds, self._place[arc], low, starts[row + 1]) - low) & 1

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one accepted path that spells the word."""
        token = self._token
        if (whole := token.get(word)) is not None:  # an arc from the start that spells it all
            return [whole]
        n, at, state, tried, dead = len(word), 0, -1, 0, set()
        place, row, starts, bounds, known = self._place, self._row, self._starts, self._bounds, self._lengths.get
        path: list[int] = []
        former: list[tuple[int, int, int]] = []  # where a path came from: position, state, lengths tried there
        lengths = self._at(word, 0)
        while at < n:
            for tried in range(tried, len(lengths)):
                end = at + lengths[tried]
                if end > n or (t := token.get(word[at:end])) is None or end in dead:
                    continue
                if state >= 0:  # ``step``, in line
                    low = starts[r := row[state]]
                    if (bisect_right(bounds, place[t], low, starts[r + 1]) - low) & 1:
                        continue
                former.append((at, state, tried + 1))
                path.append(t)
                at, state, tried = end, t, 0
                break
            else:
                if not path:
                    raise ValueError("the vocabulary lacks a byte of the word")
                dead.add(at)
                path.pop()
                at, state, tried = former.pop()
            lengths = known(word[at : at + HEAD]) or self._at(word, at)
        return path

    def decode(self, ids: list[int]) -> bytes:
        get = self.labels.__getitem__
        return b"".join(map(get, ids))


class _Words(dict):
    """Encoded words as little-endian 32-bit ids; bounded.  When it is full, its entries
    stay for one more filling, so that frequent words are never encoded anew."""

    def __init__(self, automaton: MergeAutomaton):
        super().__init__()
        self._automaton, self._former = automaton, {}

    def __missing__(self, word: str) -> bytes:
        if (packed := self._former.get(word)) is None:
            ids = self._automaton.encode(word.encode())
            packed = ids[0].to_bytes(4, "little") if len(ids) == 1 else array("I", ids).tobytes()
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORD_CACHE:
                self._former = dict(self)
                self.clear()
            self[word] = packed
        return packed


@dataclass
class Definition:
    """What a tokenizer definition says: the compiled merges, special tokens (text to id),
    and whether a space goes in front."""

    table: Compiled
    special: dict[str, int]
    prefix: bool


def definition_of(raw_json: bytes) -> Definition:
    spec = json.loads(raw_json)
    letters = byte_letters()
    raw = lambda token: bytes(letters[ch] for ch in token)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or not pre.get("use_regex", True):
        raise ValueError("not a byte-level BPE vocabulary")
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    vocab = {raw(t): i for t, i in model["vocab"].items() if t not in special}
    return Definition(compiled(vocab, [(raw(a), raw(b)) for a, b in pairs]), special, bool(pre.get("add_prefix_space")))


class ByteBPE:
    """Splitting by special tokens and words around the automaton."""

    def __init__(self, definition: Definition):
        self.special, self._prefix = definition.special, definition.prefix
        self.automaton = MergeAutomaton(definition.table)
        self._labels = dict(enumerate(self.automaton.labels)) | {i: t.encode() for t, i in self.special.items()}
        self._words = _Words(self.automaton)
        self._find = regex.compile(WORDS).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split if longest_first else None

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        get = self._words.__getitem__
        parts = [text] if self._cut is None else self._cut(text)
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                if self._prefix and not part[0].isspace():
                    part = " " + part
                out.extend(map(get, self._find(part)))
        return b"".join(out)

    def decode_packed(self, packed: bytes) -> str:
        return b"".join(map(self._labels.__getitem__, memoryview(packed).cast("I"))).decode("utf-8", "replace")


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("decoded", pa.string())])


def bpe_encode(
    docs: DataFrame, definition: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, with_text: bool = True, place_col: str | None = None
) -> DataFrame:
    """Per row: doc_id, n_tokens, token_ids, ids_sha256, decoded_sha256, decoded, and
    position where ``place_col`` names a column (whole numbers) to carry.

    ``definition``: path of a tokenizer definition (JSON, byte-level BPE); its
    compiled table is broadcast (size fixed by the vocabulary).  ``with_ids`` and
    ``with_text`` leave the large columns out.  See the module for edge cases.
    """
    spark = docs.sparkSession
    small_batches(spark)
    data = file_bytes(definition or tokenizer_file("byte_bpe_50k.json"))
    key = ("bpe", hashlib.sha256(data).hexdigest())
    shared = spark.sparkContext.broadcast(once(key, lambda: definition_of(data)))
    keep = [n for n in OUT.names if not (n == "token_ids" and not with_ids or n == "decoded" and not with_text)]
    fields = [OUT.field(n) for n in keep]
    if place_col is not None:
        keep.append("position")
        fields.append(pa.field("position", pa.int64()))
    schema = pa.schema(fields)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        bpe = once(("bpe", "words", key[1]), lambda: ByteBPE(shared.value))
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(k, ROWS_OUT)
                packed = [bpe.encode_packed(t.as_py()) for t in batch.column(1)]
                decoded = [bpe.decode_packed(x) for x in packed]
                cols = {
                    "doc_id": batch.column(0),
                    "n_tokens": [len(x) // 4 for x in packed],
                    "token_ids": [memoryview(x).cast("i").tolist() for x in packed] if with_ids else None,
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in packed],
                    "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in decoded],
                    "decoded": decoded,
                    "position": batch.column(2) if place_col is not None else None,
                }
                yield pa.RecordBatch.from_pydict({n: cols[n] for n in keep}, schema=schema)

    sql = {"doc_id": "bigint", "n_tokens": "bigint", "token_ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string", "decoded": "string", "position": "bigint"}
    place = [] if place_col is None else [F.col(place_col).cast("long").alias("position")]
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *place)
    return read.mapInArrow(encoded, ", ".join(f"{n} {sql[n]}" for n in keep))


def op1_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), with_ids=False, with_text=False)
