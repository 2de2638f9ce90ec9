"""Operator 6: language identification by a bidirectional GRU over bytes.

A text is cut into letter runs; each run, with a mark at either end, is one
byte sequence (runs over ``WINDOW`` bytes are read in consecutive windows, none
left out).  A forward and a backward gated recurrent unit read it, a softmax
labels every byte position, and a document pools the log probabilities of all its
positions.  The network is written and trained in numpy: backpropagation through
time over batches of runs, Adam, languages drawn evenly.

State starts anew at each run: what surrounds a word does not enter, only its bytes do.
So a run's summed log probabilities depend on the run alone; workers keep them in a
bounded cache and run the network on new runs only, many at a time.

Fitting uses at most ``max_docs`` documents, chosen by a hash of the id (of a repeated
id one row), and ``DOC_WINDOWS`` windows of each (documented bounds).

Results: ``und`` with score 0 for a text that is null or has no letter, and for
every text when there is nothing to learn from.  Ties go to the first language
in alphabetical order.  Extra columns are not carried.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import hash_share, lean, once, small_batches, table

MAX_DOCS, DOC_WINDOWS, WINDOW, HIDDEN, EMBED = 2_000, 2_000, 32, 16, 12
STEPS, BATCH, RATE, SEED = 1_200, 384, 0.01, 7
HELD_OUT_OF, HELD_OUT = 5, 0
RUN_CACHE, LONGEST_KEPT, AT_ONCE = 300_000, 48, 4096
PAD, MARK = 256, 257


@cache
def _runs() -> tuple[Callable[[str], list[str]], Callable[[str], list[str]]]:
    """Find runs of letters (Unicode category L): of what the pattern language calls
    alphanumeric, all but numbers of any kind.  The first is for texts without characters
    above U+FFFF: only up to there is a class a bit table, and what it holds beyond is
    tried entry by entry at every letter."""
    numbers = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isnumeric() and not unicodedata.category(chr(c)).startswith("L")]
    low = "".join(re.escape(c) for c in numbers if c <= "\uffff")
    spans: list[list[str]] = []
    for c in numbers:
        if spans and ord(c) == ord(spans[-1][1]) + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    every = "".join(f"{re.escape(first)}-{re.escape(last)}" for first, last in spans)
    return re.compile(rf"[^\W\d_{low}]+").findall, re.compile(rf"[^\W\d_{every}]+").findall


_above = re.compile("[\U00010000-\U0010ffff]").search


def letter_runs(text: str | None) -> list[str]:
    text = (text or "").lower()
    return _runs()[_above(text) is not None](text)


def windows(run: str) -> list[bytes]:
    raw = run.encode()
    return [raw[i : i + WINDOW] for i in range(0, len(raw), WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class BiGRU:
    """Weights: table (bytes -> EMBED); for each direction Wx, Wh, b; output V, c."""

    def __init__(self, langs: list[str], params: dict[str, np.ndarray] | None = None, seed: int = SEED):
        self.langs = langs
        if params is None:
            rng = np.random.default_rng(seed)
            draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
            params = {"table": rng.normal(0, 0.3, (258, EMBED)).astype(np.float32), "V": draw(2 * HIDDEN, len(langs)), "c": np.zeros(len(langs), np.float32)}
            for d in "fb":
                params |= {f"Wx{d}": draw(EMBED, 3 * HIDDEN), f"Wh{d}": draw(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p = params

    @staticmethod
    def batch(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes and mask, (longest + 2) x runs: a mark at either end, then padding."""
        size = np.array([len(x) for x in pieces])
        codes = np.full((len(pieces), int(size.max(initial=0)) + 2), PAD, np.int64)
        mask = np.arange(codes.shape[1]) < (size + 2)[:, None]
        inner = mask.copy()
        inner[:, 0] = False
        inner[np.arange(len(pieces)), size + 1] = False
        codes[inner] = np.frombuffer(b"".join(pieces), np.uint8)
        codes[:, 0] = MARK
        codes[np.arange(len(pieces)), size + 1] = MARK
        return codes.T.copy(), mask.T.astype(np.float32)

    def _pass(self, codes: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        p, H = self.p, HIDDEN
        gates = (p["table"] @ p[f"Wx{d}"] + p[f"b{d}"]).astype(np.float32)  # per byte value
        T, B = codes.shape
        h, out, tape = np.zeros((B, H), np.float32), np.zeros((T, B, H), np.float32), []
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            x, u = gates[codes[t]], h @ p[f"Wh{d}"]
            zr = _sigmoid(x[:, : 2 * H] + u[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(x[:, 2 * H :] + r * u[:, 2 * H :])
            m = mask[t][:, None]
            new = h + m * (1 - z) * (n - h)
            if keep:
                tape.append((t, h, z, r, n, u[:, 2 * H :], m))
            h = new
            out[t] = h
        return out, tape

    def log_probs(self, codes: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Log probabilities of every position (T, B, languages)."""
        f, tf = self._pass(codes, mask, "f", keep)
        b, tb = self._pass(codes, mask, "b", keep)
        s = np.concatenate([f, b], axis=2)
        logits = s @ self.p["V"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True)), (s, tf, tb)

    def gradients(self, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over positions, and its gradients through time."""
        p, H, total = self.p, HIDDEN, mask.sum()
        logp, (s, tf, tb) = self.log_probs(codes, mask, keep=True)
        each = np.arange(len(labels))
        loss = -(logp[:, each, labels] * mask).sum() / total
        dlogits = np.exp(logp)
        dlogits[:, each, labels] -= 1
        dlogits *= mask[:, :, None] / total
        g = {"V": np.tensordot(s, dlogits, ([0, 1], [0, 1])), "c": dlogits.sum((0, 1)), "table": np.zeros_like(p["table"])}
        ds = dlogits @ p["V"].T
        for d, tape, part in (("f", tf, ds[:, :, :H]), ("b", tb, ds[:, :, H:])):
            Wx, Wh = p[f"Wx{d}"], p[f"Wh{d}"]
            dgates, dWh, dh = np.zeros((258, 3 * H), np.float32), np.zeros_like(Wh), np.zeros((codes.shape[1], H), np.float32)
            for t, h, z, r, n, un, m in reversed(tape):
                dnew = dh + part[t]
                dz = dnew * m * (h - n) * z * (1 - z)
                dn = dnew * m * (1 - z) * (1 - n * n)
                dr = dn * un * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                dh = dnew * (1 - m * (1 - z)) + du @ Wh.T
                dWh += h.T @ du
                np.add.at(dgates, codes[t], np.concatenate([dz, dr, dn], axis=1))
            g[f"Wh{d}"], g[f"Wx{d}"], g[f"b{d}"] = dWh, p["table"].T @ dgates, dgates.sum(0)
            g["table"] = g["table"] + dgates @ Wx.T
        return float(loss), g

    def fit(self, pools: list[list[bytes]], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> BiGRU:
        """``pools``: the training runs of each language."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        some = [i for i, x in enumerate(pools) if x]
        for step in range(1, steps + 1):
            labels = rng.choice(some, batch)
            pieces = [pools[y][rng.integers(len(pools[y]))] for y in labels]
            _, g = self.gradients(*self.batch(pieces), labels)
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            now = rate * min(1, 1 / max(norm, 1e-9)) * (1 - 0.9 * step / steps)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


class Reader:
    """A trained network with its cache of runs."""

    def __init__(self, langs: list[str], params: dict[str, np.ndarray]):
        self.net = BiGRU(langs, params)
        self._row: dict[str, int] = {}
        self._sums = np.zeros((1024, len(langs)), np.float32)

    def _score(self, runs: list[str]) -> np.ndarray:
        """Summed log probabilities of each run (rows) over all its positions."""
        pieces, owner = [], []
        for i, run in enumerate(runs):
            for w in windows(run):
                pieces.append(w)
                owner.append(i)
        out = np.zeros((len(runs), len(self.net.langs)))
        order = np.argsort([len(p) for p in pieces], kind="stable")
        for k in range(0, len(order), AT_ONCE):
            part = order[k : k + AT_ONCE]
            codes, mask = self.net.batch([pieces[i] for i in part])
            logp, _ = self.net.log_probs(codes, mask)
            np.add.at(out, np.array(owner)[part], (logp * mask[:, :, None]).sum(0))
        return out

    def learn(self, texts: list[list[str]]) -> None:
        """Scores what the texts' runs have new, in one go."""
        fresh = [r for r in dict.fromkeys(r for runs in texts for r in runs) if r not in self._row and len(r) <= LONGEST_KEPT]
        if len(self._row) + len(fresh) > RUN_CACHE:
            self._row.clear()
            fresh = list(dict.fromkeys(r for runs in texts for r in runs if len(r) <= LONGEST_KEPT))
        if not fresh:
            return
        start, need = len(self._row), len(self._row) + len(fresh)
        if need > len(self._sums):
            grown = np.zeros((max(need, 2 * len(self._sums)), self._sums.shape[1]), np.float32)
            grown[:start] = self._sums[:start]
            self._sums = grown
        self._sums[start:need] = self._score(fresh)
        self._row.update(zip(fresh, range(start, need), strict=True))

    def pooled(self, runs: list[str]) -> tuple[str, float]:
        if not runs:
            return "und", 0.0
        known = [self._row[r] for r in runs if len(r) <= LONGEST_KEPT]
        long = [r for r in runs if len(r) > LONGEST_KEPT]
        total = self._sums[known].sum(0, dtype=np.float64)
        if long:
            total = total + self._score(long).sum(0)
        p = np.exp(total - total.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.net.langs[best], float(p[best])


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT


def train(docs: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", steps: int = STEPS) -> BiGRU | None:
    """Fits on documents that are not held out and have a language; None without any.
    Runs are cut on the executors; the driver gets at most ``DOC_WINDOWS`` windows of
    each chosen document, evenly spread over it."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("id").isNotNull()).where(~held_out("id"))
    ids = hash_share(known.select("id"), F.col("id"), 4 * max_docs).distinct().orderBy(F.xxhash64("id"), "id").limit(max_docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            found = [[w for run in letter_runs(t.as_py()) for w in windows(run)] for t in batch.column(2)]
            some = [[ws[i * len(ws) // DOC_WINDOWS] for i in range(DOC_WINDOWS)] if len(ws) > DOC_WINDOWS else ws for ws in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(some, pa.list_(pa.binary()))], names=["id", "lang", "runs"])

    chosen = known.join(F.broadcast(ids), "id", "left_semi").select(F.col("id").cast("string").alias("id"), "lang", "text")
    # of a repeated id one row; ids: max_docs at most
    rows = chosen.mapInArrow(cut, "id string, lang string, runs array<binary>").groupBy("id").agg(F.min(F.struct("lang", "runs")).alias("x")).select("id", "x.*").collect()
    rows.sort(key=lambda r: (zlib.crc32(r.id.encode()), r.id))
    langs = sorted({r.lang for r in rows})
    pools = [[bytes(w) for r in rows if r.lang == x for w in r.runs] for x in langs]
    if not any(pools):
        return None
    return BiGRU(langs).fit(pools, steps=steps)


def predict(docs: DataFrame, net: BiGRU | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(None if net is None else (net.langs, net.p))
    key = None if net is None else ("bigru", tuple(net.langs), zlib.crc32(b"".join(net.p[k].tobytes() for k in sorted(net.p))))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        reader = None if shared.value is None else once(key, lambda: Reader(*shared.value))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [letter_runs(t.as_py()) for t in part.column(1)]
                if reader is not None:
                    reader.learn(texts)
                found = [("und", 0.0) if reader is None else reader.pooled(runs) for runs in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(predicted, "doc_id bigint, lang_pred string, score double")


def op6_language_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
