"""Chat formatting against its SQL, and its edge cases."""

from planweave.llm import chat, queries
from tests.compare import DATA, duck, same


def test_equals_sql(spark):
    same(queries.queries()["op10_chat_formatting"](spark, DATA), duck(), queries.oracle_sql()["op10_chat_formatting"])


def test_rotation_and_cases(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "late"), (2, 0, "system", "only"), (None, 0, "ann", "x")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, perspective long")
    out = chat.rotate(df, chunk=1).collect()
    assert {r.conv_id for r in out} == {1} and {r.perspective for r in out} == {"ann", "bob", "unknown"}
    for p in ("ann", "bob", "unknown"):
        own = sorted((r for r in out if r.perspective == p), key=lambda r: r.seq)
        whole = "".join(r.rendered for r in own)
        assert [r.seq for r in own] == list(range(5)) and whole.count("<|end|>") == 5
        for r in own:
            assert whole[r.char_start : r.char_end] == r.rendered and (r.open_start is None) == (r.role != p)
            if r.role == p:
                assert whole[r.open_start : r.open_end].endswith("<|end|>") and "<|assistant|>" not in whole[r.open_start : r.open_end]


def test_empty(spark):
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
