import pytest
from oracle_check import SF, compare, connect

from fundalake.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    compare(QUERIES[name](spark, SF), SQL[name], connect())


def test_chat_with_null_ids_and_turns(spark, tmp_path):
    """A row without a conv_id is a conversation of its own, in the operator and in its SQL; a null turn is turn 0."""
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (None, 1, "assistant", None), (3, None, "user", "q"), (3, 1, "assistant", "r"), (4, 0, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = connect()
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    out = QUERIES["op4_chat_format"](spark, str(tmp_path))
    compare(out, SQL["op4_chat_format"], con)
    assert out.filter("conv_id is null").count() == 3
