import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldtally.sinks import write_table
from fieldtally.sources import (
    CUSTOMERS_SCHEMA,
    ORDERS_SCHEMA,
    POSITIONS_SCHEMA,
    read_edge_list,
    read_pipe_table,
    read_positions,
    read_tagged_tables,
)

CUSTOMER = "1|A|x,y|3|555|1000.0|AUTO|fine"
ORDER = "7|1|O|10.5|1995-01-02|HIGH|clerk|0|ok"


def test_pipe_tables(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text(CUSTOMER + "\n\n")
    (tmp_path / "b.csv").write_text(CUSTOMER.replace("1|A", "2|B") + "\n")
    both = read_pipe_table(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], CUSTOMERS_SCHEMA)
    assert rows(both, "custkey", "name", "address", "acctbal") == [(1, "A", "x,y", 1000.0), (2, "B", "x,y", 1000.0)]
    (tmp_path / "o.csv").write_text(ORDER + "\n")
    order = read_pipe_table(spark, str(tmp_path / "o.csv"), ORDERS_SCHEMA).first()
    assert (order["custkey"], order["price"], str(order["orderdate"])) == (1, 10.5, "1995-01-02")


@pytest.mark.parametrize("line", ["x|A|x,y|3|555|1000.0|AUTO|fine", "1|A|x,y"])
def test_malformed_lines(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(CUSTOMER + "\n" + line + "\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_pipe_table(spark, str(tmp_path / "a.csv"), CUSTOMERS_SCHEMA).collect()
    lenient = read_pipe_table(spark, str(tmp_path / "a.csv"), CUSTOMERS_SCHEMA, mode="PERMISSIVE").cache()
    assert [row["_corrupt_record"] for row in lenient.orderBy("name").collect()].count(line) == 1


def test_write_and_read_back(spark, tmp_path, rows):
    data = [(1, "A", 'say "x|y"', 3, None, 1.5, "back\\slash", "x,y"), (10, "B", "a|b", 4, "5", 2.5, "S", '"')]
    df = spark.createDataFrame(data, CUSTOMERS_SCHEMA)
    write_table(df, str(tmp_path / "t"))
    assert rows(read_pipe_table(spark, str(tmp_path / "t"), CUSTOMERS_SCHEMA)) == data
    with pytest.raises(PySparkException, match="exists"):
        write_table(df, str(tmp_path / "t"))
    write_table(df, str(tmp_path / "t"), mode="overwrite")


def test_text_order(spark, tmp_path):
    write_table(spark.range(1, 25).select("id"), str(tmp_path / "t"), order_by=["id"])
    files = sorted((tmp_path / "t").glob("part-*"))
    found = [line for file in files for line in file.read_text().split()]
    assert found == sorted(str(n) for n in range(1, 25))
    write_table(spark.range(1, 25).select("id"), str(tmp_path / "n"), order_by=["id"], as_text=False)
    found = [int(line) for file in sorted((tmp_path / "n").glob("part-*")) for line in file.read_text().split()]
    assert found == list(range(1, 25))


def test_tables_told_apart_by_file_name(spark, tmp_path, rows):
    (tmp_path / "People.csv").write_text(CUSTOMER + "\n")
    (tmp_path / "ORDERS.csv").write_text(ORDER + "\n")
    folder = tmp_path / "more" / "orders.csv"
    folder.mkdir(parents=True)
    (folder / "part-0").write_text(ORDER.replace("7|1", "8|1") + "\n")
    read = read_tagged_tables(
        spark,
        [str(tmp_path / "People.csv"), str(tmp_path / "ORDERS.csv"), str(folder)],
        {"customers.csv": CUSTOMERS_SCHEMA, "orders.csv": ORDERS_SCHEMA},
        default="customers.csv",
    )
    assert rows(read["customers.csv"], "custkey", "name") == [(1, "A")]
    assert rows(read["orders.csv"], "orderkey") == [(7,), (8,)]


def test_edge_list(spark, tmp_path, rows):
    (tmp_path / "e.txt").write_text("FromNodeId\tToNodeId\n17274\t2\n2\t4\n")
    assert rows(read_edge_list(spark, str(tmp_path / "e.txt"))) == [(2, 4), (17274, 2)]
    (tmp_path / "n.txt").write_text("17274\t2\n")
    assert rows(read_edge_list(spark, str(tmp_path / "n.txt"), header=False)) == [(17274, 2)]


def test_positions(spark, tmp_path, rows):
    (tmp_path / "p.csv").write_text("47,14879639146403495,1,-2,3,4,5,6,7,8,9,10,11\n")
    df = read_positions(spark, str(tmp_path / "p.csv"))
    assert df.columns == [*POSITIONS_SCHEMA.names, "ts"]
    assert rows(df, "sensor_id", "x", "y", "acceleration_z") == [(47, 1, -2, 11)]
    assert rows(df.select(F.unix_millis("ts"))) == [(14879639,)]
    (tmp_path / "q.csv").write_text("47,14879639146403495,1,-2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_positions(spark, str(tmp_path / "q.csv")).collect()
