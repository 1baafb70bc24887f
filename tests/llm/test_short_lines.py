"""Short lines and scripts without blanks in op4, against plain comparison."""

from collections import Counter

import brute
import pytest

from barloom.llm import line_dedup
from barloom.llm import queries as q

@pytest.mark.parametrize("kind", ["sf", "odd"])
def test_op4(spark, kind, sf_dir, odd_dir):
    folder = {"sf": sf_dir, "odd": odd_dir}[kind]
    texts = brute.docs(folder)
    left = brute.deduplicated_lines(texts)
    rows = q.op4(spark, folder).select("doc_id", "n_dropped", "kept_sha256").collect()
    assert Counter(map(tuple, rows)) == Counter(
        (i, t.count("\n") - left[i].count("\n"), brute.sha(left[i])) for i, t in texts
    )


def test_short_and_wide_lines(spark):
    texts = [
        (1, "Home\n\n  \nShare this\n©  2024 Example\nShare that"),
        (2, "Home\nShare  this\t\n\nhome\n© 2024 Example\na b c d\na b c e\na b c d e"),
        (3, "这是一个完整的句子。\n今日は良い天気です\nสวัสดีชาวโลก\n漢字かな\n\U00020000x\U00020001"),
        (4, "这是一个完整的句子。\n今日は悪い天気です\nสวัสดีชาวโลก!\n漢字かに\n漢字 かな\n\U00020000x\U00020001"),
        (5, "Home"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r[0]: r[1] for r in line_dedup.without_near_lines(docs).collect()}
    assert got == brute.deduplicated_lines(texts)
    assert got[2] == "\nhome\na b c d\na b c e\na b c d e"
    assert got[4] == "漢字かに" and got[5] == ""
