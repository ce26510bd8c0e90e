"""The whole way from documents to packed chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from quire import fixed_values as V
from quire.operators.cleaning import accepted, gate
from quire.operators.packing import pack
from quire.operators.splitting import exact_split
from quire.operators.tokens import WordTokenizer, stories
from quire.staging import stage


@dataclass(frozen=True)
class CorpusSettings:
    min_length: int = V.MIN_LENGTH
    train_ratio: float = V.TRAIN_RATIO
    seed: int = V.SEED
    max_length: int = V.MAX_LENGTH
    overlap: int = V.OVERLAP


def clean_and_split(documents: DataFrame, settings: CorpusSettings) -> DataFrame:
    """``(doc_id, text, split)`` of the documents that pass the gate. Cleaning runs once."""
    texts = documents.select("doc_id", "text")
    cleaned = stage(stories(accepted(gate(texts, settings.min_length))), "cleaned")
    return exact_split(cleaned, ratio=settings.train_ratio, seed=settings.seed)


def build_corpus(
    documents: DataFrame, settings: CorpusSettings = CorpusSettings(), tokenizer=None
) -> DataFrame:
    """Clean, split, tokenize and pack ``(doc_id, text)``: ``(split, chunk_id, input_ids)``.

    Without a tokenizer a word tokenizer is fitted to the cleaned documents.
    """
    split = clean_and_split(documents, settings)
    tokenizer = tokenizer or WordTokenizer.fit(split)
    return pack(tokenizer.transform(split), settings.max_length, settings.overlap)
