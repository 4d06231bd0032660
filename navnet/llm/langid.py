"""Language identification by prediction by partial matching (PPM, escape method C with exclusion).

One variable-order byte context tree per language is filled from a bounded sample of labelled documents; its statistics
are then frozen. Because nothing adapts while scoring, the code length of every (context, byte) under every language is
a constant, so the trees are unfolded once into a table and a text's exact code length is a sum of look-ups.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes scored at once; a longer text is scored in slices that carry the context over.
_SLICE = 1 << 20


#: Nodes whose probabilities are worked out at once.
_NODES = 4096


@dataclass
class PpmModel:
    """Frozen trees: symbol (of a byte), node (of the last three symbols), bits (node x symbol, by language)."""

    languages: list[str]
    symbol: np.ndarray
    node: np.ndarray
    bits: np.ndarray

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language: exact sums of code lengths, shape (texts, languages)."""
        out = np.zeros((len(texts), len(self.languages)))
        group: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if len(text) > _SLICE:
                for at in range(0, len(text), _SLICE):
                    out[i] += self._sums([text[max(0, at - 3) : at].rjust(3, b"\n") + text[at : at + _SLICE]])[0]
                continue
            group.append(i)
            size += len(text)
            if size >= _SLICE:
                out[group] = self._sums([b"\n\n\n" + texts[j] for j in group])
                group, size = [], 0
        if group:
            out[group] = self._sums([b"\n\n\n" + texts[j] for j in group])
        return out

    def _sums(self, texts: list[bytes]) -> np.ndarray:
        a = self.bits.shape[0] // self.node_count
        s = self.symbol[np.frombuffer(b"".join(texts), np.uint8)]
        node = self.node[(s[:-3] * a + s[1:-2]) * a + s[2:-1]]
        index = node * a + s[3:]
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        start = np.cumsum(lengths) - lengths
        keep = lengths > 3
        out = np.zeros((len(texts), len(self.languages)))
        # Sums run from a text's first byte to the next text's first: the three bytes of padding between are taken off.
        edges = np.empty(2 * len(texts), np.int64)
        edges[0::2], edges[1::2] = start, start + lengths - 3
        edges = edges[np.repeat(keep, 2)]
        if len(edges):
            for k in range(len(self.languages)):
                bits = self.bits[:, k][index].astype(np.float64)
                out[keep, k] = np.add.reduceat(np.append(bits, 0.0), edges)[0::2]
        return out

    @property
    def node_count(self) -> int:
        return int(self.node.max()) + 1 if len(self.node) else 1


def train(samples: dict[str, list[bytes]]) -> PpmModel:
    """Trees of order 3 from lower-cased sample texts by language."""
    languages = sorted(samples)
    if not languages:
        return PpmModel([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    joined = {k: np.frombuffer(b"".join(b"\n\n\n" + t for t in samples[k]) or b"\n\n\n", np.uint8) for k in languages}
    seen = np.unique(np.concatenate([*joined.values(), np.frombuffer(b"\n", np.uint8)]))
    a = len(seen) + 1  # the last symbol stands for every byte that no sample has
    symbol = np.full(256, a - 1, np.int64)
    symbol[seen] = np.arange(a - 1)
    texts = {k: symbol[v] for k, v in joined.items()}

    def contexts(s: np.ndarray, order: int) -> np.ndarray:
        key = np.zeros(len(s) - 3, np.int64)
        for back in range(order, 0, -1):
            key = key * a + s[3 - back : len(s) - back]
        return key

    keys = [np.unique(np.concatenate([contexts(s, order) for s in texts.values()])) for order in range(4)]
    first = np.cumsum([0, *(len(k) for k in keys)])
    node = np.zeros((a, a, a), np.int32)
    node[:, :, keys[1]] = first[1] + np.arange(len(keys[1]), dtype=np.int32)
    node[:, keys[2] // a, keys[2] % a] = first[2] + np.arange(len(keys[2]), dtype=np.int32)
    node.reshape(-1)[keys[3]] = first[3] + np.arange(len(keys[3]), dtype=np.int32)
    bits = np.empty((first[-1] * a, len(languages)), np.float32, order="F")
    more = np.log2(256 - (a - 1)) if a <= 256 else 0.0
    for k, lang in enumerate(languages):  # one language, some nodes at a time: of doubles, the driver holds little at once
        s, longest = texts[lang], np.full((1, a), 1.0 / a)
        for order, known in enumerate(keys):
            at = np.searchsorted(known, contexts(s, order))
            by = np.argsort(at, kind="stable")
            at, symbols = at[by], s[3:][by]
            last, longest = longest, np.empty((len(known), a)) if order < 3 else None
            for lo in range(0, len(known), _NODES):
                own = known[lo : lo + _NODES]
                shorter = last[np.searchsorted(keys[order - 1], own % a ** (order - 1))] if order else last
                i, j = np.searchsorted(at, [lo, lo + len(own)])
                n = np.bincount((at[i:j] - lo) * a + symbols[i:j], minlength=len(own) * a).reshape(len(own), a).astype(float)
                total, distinct = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
                unseen = np.where(n > 0, 0.0, shorter)
                mass = unseen.sum(1, keepdims=True)
                full = mass <= 0  # every symbol has been seen: nothing to escape to
                with np.errstate(divide="ignore", invalid="ignore"):
                    p = np.where(n > 0, n / np.where(full, total, total + distinct), distinct / (total + distinct) * unseen / mass)
                p = np.where(total > 0, p, shorter)
                if longest is not None:
                    longest[lo : lo + len(own)] = p
                p = -np.log2(p)
                p[:, a - 1] += more
                bits[(first[order] + lo) * a : (first[order] + lo + len(own)) * a, k] = p.reshape(-1)
    return PpmModel(languages, symbol, node.reshape(-1), bits)


def fold(text: str) -> bytes:
    return text.encode().lower()


def labelled_sample(docs: DataFrame, learn: Column, per_language: int, max_bytes: int) -> dict[str, list[bytes]]:
    """At most per_language documents of each language, the first max_bytes characters of each, by the smallest hashes of doc_id.

    The ids are chosen first (in 64 parts of each language, then over the parts: no language is ever one task's), then
    the texts of that bounded list of ids are fetched.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("doc_id", "lang", "text")
    ids = rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(10)).alias("h")).withColumn("part", F.pmod("h", F.lit(64)))
    for by in (["lang", "part"], ["lang"]):
        ids = ids.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id"))).where(F.col("r") <= per_language)
    ids = ids.select("doc_id", "lang").distinct()
    out: dict[str, list[bytes]] = {}
    same = rows["doc_id"].eqNullSafe(ids["doc_id"]) & (rows["lang"] == ids["lang"])
    for lang, text in rows.join(F.broadcast(ids), same, "left_semi").select("lang", F.substring("text", 1, max_bytes).alias("text")).orderBy("lang", "doc_id", "text").collect():
        if len(own := out.setdefault(lang, [])) < per_language:
            own.append(fold(text))
    return out


def identify(docs: DataFrame, model: PpmModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep, and lang_pred, score, bits_per_byte (these win over columns of keep) of every row of docs, whole texts.

    lang_pred: the language with the shortest code (a tie: the first by name); und if text is null or has no letter, or
    if no language was learnt. score: that language's posterior under equal priors, 0 for und. bits_per_byte: the
    shortest code's bits over the text's bytes, null for und. Repeated rows give repeated results; an empty table none.
    """
    added = ("lang_pred", "score", "bits_per_byte")
    return _identified(docs, model, keep).select(*[c for c, name in zip(_kept(keep), keep, strict=True) if name not in added], *added)


def recognised(docs: DataFrame, model: PpmModel) -> DataFrame:
    """The rows of docs, all columns, whose text is in a learnt language."""
    found = _identified(docs, model, tuple(docs.columns)).where(F.col("lang_pred") != UNDETERMINED)
    return found.select(*_kept(docs.columns))


def _kept(keep: tuple[str, ...]) -> list[Column]:
    """The columns keep of _identified()."""
    return [(F.col("_text") if c == "text" else F.col("_row")[f"c{i}"]).alias(c) for i, c in enumerate(keep)]


def _identified(docs: DataFrame, model: PpmModel, keep: tuple[str, ...]) -> DataFrame:
    """_row (a struct of keep, by number, without the text), _text if it is kept, lang_pred, score, bits_per_byte."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep) if c != "text"])
    rows, whole = docs.select(row.alias("_row"), "text"), "text" in keep

    def run(batch: pa.RecordBatch) -> dict:
        m = shared.value
        texts = batch.column("text").to_pylist()
        good = [i for i, t in enumerate(texts) if m.languages and t and _LETTER.search(t)]
        langs, scores, rates = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
        raw = [fold(texts[i]) for i in good]
        for i, text, bits in zip(good, raw, m.code_lengths(raw), strict=True):
            best = int(bits.argmin())
            langs[i], scores[i], rates[i] = m.languages[best], float(1.0 / np.exp2(bits[best] - bits).sum()), float(bits[best] / len(text))
        return {"_row": batch.column("_row"), **({"_text": batch.column("text")} if whole else {}), "lang_pred": langs, "score": scores, "bits_per_byte": rates}

    return arrow_map(rows, run, f"_row {dict(rows.dtypes)['_row']}, {'_text string, ' if whole else ''}lang_pred string, score double, bits_per_byte double")


def fitted(docs: DataFrame, per_language: int = 160, max_bytes: int = 16384) -> PpmModel:
    """The model of op10: learns from what is not held_out(). The sample's bound is per_language documents of max_bytes
    characters each; 160 documents of each language reach full accuracy here."""
    return train(labelled_sample(docs, ~held_out(), per_language, max_bytes))


def held_out() -> Column:
    """crc32(doc_id as text) mod 3 is 1; a row without doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
