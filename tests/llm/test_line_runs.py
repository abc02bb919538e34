"""Line dedup of passages that many documents share."""

from quire.llm import lines


def dedup(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["text"].split("\n") for r in lines.dedup_lines(frame).collect()}


def own(i):
    return f"Document {i} has this line alone, {i}."


def test_frequent_passages_meet_a_document_they_align_with(spark):
    a, b, c = (f"{x} line of thirty characters.."[:30] for x in "abc")
    hot = "A license line that very many of the documents have in common."
    rows = [(k, "\n".join([own(k), s, own(-k)])) for k, s in enumerate((a, b, c), 1)]
    rows += [(4, "\n".join([c, own(4), b, own(-4), a]))]
    rows += [(10 + i, "\n".join([own(10 + i), a, b, c, f"end {i}"])) for i in range(20)]
    rows += [(100, "\n".join([hot, own(100), hot, own(-100)]))]
    rows += [(101 + i, "\n".join([own(101 + i), hot, f"tail {i}"])) for i in range(20)]
    found = dedup(spark, rows)
    assert all(found[i] == text.split("\n") for i, text in rows if i in (1, 2, 3, 4, 10, 100, 101))
    assert all(found[10 + i] == [own(10 + i), f"end {i}"] for i in range(1, 20))
    assert all(found[101 + i] == [own(101 + i), f"tail {i}"] for i in range(1, 20))


def test_blocks_of_short_lines_go(spark):
    verse = [f"short line {k}" for k in range(8)]
    cjk = [chr(0x4E00 + k) * 7 for k in range(9)]
    rows = [(i, "\n".join([own(i), *verse, own(-i), *cjk, f"tail {i}"])) for i in (1, 2)]
    rows += [(20 + i, "\n".join([own(20 + i), "", *verse[:4], "", *verse[4:], f"tail {20 + i}"])) for i in range(12)]
    rows += [(40, "\n".join([own(40), *verse[:4], f"tail {40}"]))]  # 48 characters
    found = dedup(spark, rows)
    assert found[1] == rows[0][1].split("\n") and found[2] == [own(2), own(-2), "tail 2"]
    assert all(found[20 + i] == [own(20 + i), f"tail {20 + i}"] for i in range(1, 12))
    assert found[40] == rows[-1][1].split("\n")
