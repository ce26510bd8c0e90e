"""Language identification with a bidirectional gated recurrent network over bytes.

The network is numpy code: a gated recurrent layer of ``HIDDEN`` units per direction over the bytes of
the lower-cased text, and a softmax over the learned languages at every position. It is trained by
backpropagation through time with Adam on a bounded sample: at most ``SAMPLE`` documents per language
(chosen by a hash of id and text, of all training documents), of each ``SNIPPETS`` snippets of
``SNIPPET`` characters. At most the ``MAX_LANGUAGES`` commonest languages are learned.

Prediction reads whole texts. A text is cut into segments of ``SEGMENT`` bytes that are run side by side, every
position is labelled, and the document's probabilities are the mean over its letter positions.

Defined cases: a null text and one without a letter are ``und`` with score 0, and so is every text when
there is nothing to learn from. A null ``doc_id`` counts as the empty text in the hold-out rule. Repeated
rows are predicted each; other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
HIDDEN = 8
SEGMENT = 128
SEGMENTS_AT_ONCE = 1024
SAMPLE = 300
SNIPPETS, SNIPPET = 3, 160
MAX_LANGUAGES = 200
STEPS, BATCH, WINDOW, RATE = 200, 96, 64, 0.02
SEED = 11
_ASCII_LETTER = re.compile("[A-Za-z]")
# Bytes that are part of letters: lower-case ASCII and all bytes of other characters.
_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)], np.float32)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(c.isalpha() for c in text))


def _gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid, in place."""
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


class BidirectionalGru:
    """Parameters, the forward pass and its gradient. Arrays are ``(time, batch, ...)``."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        self.languages, self.hidden = languages, hidden
        random = np.random.default_rng(seed)
        draw = lambda *shape, scale: random.normal(scale=scale, size=shape).astype(np.float32)
        self.parameters = {"out": draw(2 * hidden, len(languages), scale=0.3), "bias": np.zeros(len(languages), np.float32)}
        for side in ("forward", "backward"):
            self.parameters[f"{side}_in"] = draw(256, 3 * hidden, scale=0.4)
            self.parameters[f"{side}_state"] = draw(hidden, 3 * hidden, scale=hidden**-0.5)

    def run(self, side: str, data: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction; ``data`` is in the order of reading. ``keep`` gets what the gradient needs."""
        inputs, recurrent, h = self.parameters[f"{side}_in"], self.parameters[f"{side}_state"], self.hidden
        state = np.zeros((data.shape[1], h), np.float32)
        states = np.empty((*data.shape, h), np.float32)
        for t in range(len(data)):
            a, g = inputs[data[t]], state @ recurrent
            gates = _gate(a[:, : 2 * h] + g[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(a[:, 2 * h :] + reset * g[:, 2 * h :])
            if keep is not None:
                keep.append((state, update, reset, candidate, g[:, 2 * h :].copy()))
            state = state - candidate
            state *= update
            state += candidate
            state *= mask[t][:, None]
            states[t] = state
        return states

    def probabilities(self, data: np.ndarray, mask: np.ndarray, keeps: tuple = (None, None)) -> tuple[np.ndarray, np.ndarray]:
        """``(probabilities, states)`` of every position."""
        forward = self.run("forward", data, mask, keeps[0])
        backward = self.run("backward", data[::-1], mask[::-1], keeps[1])[::-1]
        states = np.concatenate([forward, backward], axis=2)
        logits = states.reshape(-1, 2 * self.hidden) @ self.parameters["out"]
        logits += self.parameters["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits.reshape(*data.shape, -1), states

    def gradient(self, data: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Weighted cross entropy of all positions and its gradient, by backpropagation through time."""
        keeps: tuple[list, list] = ([], [])
        probability, states = self.probabilities(data, mask, keeps)
        n = max(float(weight.sum()), 1.0)
        wrong = probability.copy()
        at = np.arange(data.shape[1])
        loss = -float((np.log(probability[:, at, target] + 1e-9) * weight).sum()) / n
        wrong[:, at, target] -= 1
        wrong *= weight[:, :, None] / n
        flat = wrong.reshape(-1, wrong.shape[2])
        gradient = {"out": states.reshape(-1, 2 * self.hidden).T @ flat, "bias": flat.sum(0)}
        into = (flat @ self.parameters["out"].T).reshape(states.shape)
        self._through_time("forward", data, mask, into[:, :, : self.hidden], keeps[0], gradient)
        self._through_time("backward", data[::-1], mask[::-1], into[::-1, :, self.hidden :], keeps[1], gradient)
        return loss, gradient

    def _through_time(self, side, data, mask, into, keep, gradient) -> None:
        recurrent, h = self.parameters[f"{side}_state"], self.hidden
        d_recurrent, d_inputs = np.zeros_like(recurrent), np.zeros((*data.shape, 3 * h), np.float32)
        d_state = np.zeros((data.shape[1], h), np.float32)
        for t in range(len(data) - 1, -1, -1):
            state, update, reset, candidate, g = keep[t]
            d_new = (d_state + into[t]) * mask[t][:, None]
            d_candidate = d_new * (1 - update) * (1 - candidate * candidate)
            d_update = d_new * (state - candidate) * (0.25 * ((update > 0) & (update < 1)))
            d_reset = d_candidate * g * (0.25 * ((reset > 0) & (reset < 1)))
            d_inputs[t] = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            d_g = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
            d_recurrent += state.T @ d_g
            d_state = d_new * update + d_g @ recurrent.T
        gradient[f"{side}_state"] = d_recurrent
        d_table = np.zeros_like(self.parameters[f"{side}_in"])
        np.add.at(d_table, data.reshape(-1), d_inputs.reshape(-1, 3 * h))
        gradient[f"{side}_in"] = d_table


def train(samples: list[tuple[str, str]], seed: int = SEED) -> BidirectionalGru | None:
    """A network fitted to ``(language, snippet)``; every language has the same weight."""
    by_language: dict[str, list[np.ndarray]] = {}
    for language, text in sorted(samples):
        content = np.frombuffer(text.lower().encode(), np.uint8)
        if len(content):
            by_language.setdefault(language, []).append(content)
    if not by_language:
        return None
    languages = sorted(by_language)
    network, random = BidirectionalGru(languages, seed=seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.parameters.items()}
    second = {k: np.zeros_like(v) for k, v in network.parameters.items()}
    for step in range(1, STEPS + 1):
        target = random.integers(len(languages), size=BATCH)
        data, mask = np.zeros((WINDOW, BATCH), np.uint8), np.zeros((WINDOW, BATCH), np.float32)
        for i, language in enumerate(target):
            texts = by_language[languages[language]]
            content = texts[random.integers(len(texts))]
            start = random.integers(max(1, len(content) - WINDOW + 1))
            piece = content[start : start + WINDOW]
            data[: len(piece), i], mask[: len(piece), i] = piece, 1
        _, gradient = network.gradient(data, mask, target, mask * _LETTER[data])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradient.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for name, g in gradient.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            moved = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
            network.parameters[name] -= (rate * moved).astype(np.float32)
    return network


def label_texts(network: BidirectionalGru, texts: list[str]) -> np.ndarray:
    """Mean language probabilities over the letter positions of each text."""
    contents = [np.frombuffer(t.lower().encode(), np.uint8) for t in texts]
    sums, weights = np.zeros((len(texts), len(network.languages))), np.zeros(len(texts))
    owners = np.repeat(np.arange(len(texts)), [-(-len(c) // SEGMENT) for c in contents])
    segments, lengths = np.zeros((len(owners), SEGMENT), np.uint8), np.zeros(len(owners), np.int64)
    at = 0
    for content in contents:
        n = -(-len(content) // SEGMENT)
        segments[at : at + n].reshape(-1)[: len(content)] = content
        lengths[at : at + n] = np.minimum(len(content) - np.arange(n) * SEGMENT, SEGMENT)
        at += n
    for low in range(0, len(owners), SEGMENTS_AT_ONCE):
        part = np.ascontiguousarray(segments[low : low + SEGMENTS_AT_ONCE].T)
        mask = (np.arange(SEGMENT)[:, None] < lengths[None, low : low + SEGMENTS_AT_ONCE]).astype(np.float32)
        probability, _ = network.probabilities(part, mask)
        weight = mask * _LETTER[part]
        owner = owners[low : low + SEGMENTS_AT_ONCE]
        np.add.at(sums, owner, np.einsum("tbk,tb->bk", probability, weight))
        np.add.at(weights, owner, weight.sum(0))
    return sums / np.maximum(weights, 1)[:, None]


def training_sample(docs: DataFrame) -> list[tuple[str, str]]:
    """``(language, snippet)`` of at most ``SAMPLE`` training documents per language, chosen by a hash of id and text."""
    number = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))
    text = F.col("text").cast("string")
    labelled = docs.filter(F.col("lang").isNotNull() & text.isNotNull() & (F.crc32(number) % FOLDS != HELD_OUT))
    counts = labelled.groupBy(F.col("lang").cast("string").alias("lang")).count()
    counts = counts.orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, min(1.0, 1.2 * SAMPLE / r["count"]))])
    # Equal rows have one place, so a hot id or a repeated row is chosen once.
    place = F.xxhash64(number, text)
    some = (place / F.lit(2.0**64) + 0.5) < F.try_element_at(share, F.col("lang").cast("string"))
    spot = lambda k: F.floor(F.pmod(F.xxhash64(number, F.lit(k)), F.greatest(F.length(text) - SNIPPET + 1, F.lit(1)))).cast("int")
    snippets = F.array(*[F.substring(text, spot(k) + 1, F.lit(SNIPPET)) for k in range(SNIPPETS)])
    chosen = labelled.filter(some).select(F.col("lang").cast("string").alias("lang"), place.alias("place"), snippets.alias("snippets"))
    once = chosen.groupBy("lang", "place").agg(F.min("snippets").alias("snippets"))
    nearest = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    rows = once.withColumn("_at", nearest).filter(F.col("_at") <= SAMPLE).select("lang", F.explode("snippets").alias("snippet")).collect()
    return [(r.lang, r.snippet) for r in rows]


_NETWORKS: dict[str, BidirectionalGru] = {}


def predict(docs: DataFrame, network: BidirectionalGru | None, returned: list[str] | None = None) -> DataFrame:
    """``(row, lang_pred, score)``: ``row`` has the ``returned`` columns of the document, all if not given."""
    returned = docs.columns if returned is None else returned
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in returned]).alias("row"))
    out = out.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}).schema
    shared, name = docs.sparkSession.sparkContext.broadcast(network), uuid.uuid4().hex

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _NETWORKS.setdefault(name, shared.value)
        for whole in batches:
            for low in range(0, whole.num_rows, 128):
                row = whole.slice(low, 128)["row"]
                texts = row.field("text").cast(pa.string()).to_pylist()
                known = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
                languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                for i, p in zip(known, label_texts(model, [texts[i] for i in known]) if known else ()):
                    languages[i], scores[i] = model.languages[int(p.argmax())], min(1.0, float(p.max()))
                kept = pa.StructArray.from_arrays([row.field(c) for c in returned], returned)
                yield pa.RecordBatch.from_arrays([kept, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    return rows.mapInArrow(label, out)


def identify(docs: DataFrame) -> DataFrame:
    """``predict`` with a network trained on the labelled training documents among ``docs``."""
    return predict(docs, train(training_sample(docs)))


def language_rows(docs: DataFrame) -> DataFrame:
    number = F.coalesce(F.col("row.doc_id").cast("bigint").cast("string"), F.lit(""))
    found = predict(docs.select("doc_id", "text"), train(training_sample(docs)), ["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), (F.crc32(number) % FOLDS == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
