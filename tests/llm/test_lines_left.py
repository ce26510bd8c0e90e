import corpus_pipeline


def test_only_blank_documents_go(spark, rows):
    line, rest = "The same line of some words, in English.", "这是一个很长的句子没有空格。" * 50
    data = [(1, line), (2, f"{line}\n{rest}"), (3, f"{line}\nshort rest"), (4, f" \u3000\n{line}\n"), (5, ""), (6, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = rows(corpus_pipeline.drop_repeated_lines(spark, docs, ""), "doc_id", "text")
    assert got == [(1, line), (2, rest), (3, "short rest"), (5, ""), (6, None)]
