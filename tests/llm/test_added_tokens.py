import public_tokenizers
from test_best_fit_packing import check
from tokenizers import Tokenizer

from quire.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_library_as_it_is(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  \n", " <|endoftext", "don't  <|endoftext|>\n\n y", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(packing.packed_pieces(docs, PATH).collect(), dict(enumerate(texts)), Tokenizer.from_file(PATH))
