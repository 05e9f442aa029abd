"""Lines below 24 characters: equal ones go, close ones by fewer edits, blank ones stay."""

from petrichor.llm import line_dedup
from petrichor.llm.queries import QUERIES


def test_short_lines(spark):
    rows = [
        (1, "Read more\n\nclick here to continue\nabcdefghijkl\nabc"),
        (2, "Read more\n\nclick here to continua\nabcdefghijkx\nabd"),
        (3, "Read morf\n  \nclick here to cantinua\nabcdefghij\nabc"),
        (4, "exactly twenty three chr\nexactly twenty three chrs!\nexactly twenty three ch"),
    ]
    want = {
        1: rows[0][1],
        2: "\nabd",
        3: "Read morf\n  \nabcdefghij",
        4: "exactly twenty three chr",
    }
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.without_similar_lines(df, short_lines=True).collect()}
    assert found == want


def test_the_query_removes_short_repeats(spark, tmp_path):
    df = spark.createDataFrame([(1, "Read more"), (2, "Read more\nelse")], "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.n_removed for r in QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()} == {1: 0, 2: 1}
