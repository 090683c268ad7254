"""Every registered query against its SQL, exactly; queries without SQL must give rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, con, sf_dir):
    assert difference(queries()[name], oracle_sql().get(name), spark, con, sf_dir) is None


def test_entry(spark):
    assert entry(spark).columns[0] == "window_start"
    assert not entry(spark).isEmpty()


def test_every_operator_with_a_data_check_is_registered():
    wanted = (
        "s1 s2 s3 s4 s6 s9 s10 s11 s12 v3 v4 v6 v7 p1 p2 p3 p4 p5 p6 p7 p8 p9 p12 p13 p14 p15 p16 p17 "
        "f1 f2 f3 f4 f5 f6 f7 f8 j1 j2 j3 j4 j5 j6 j7 j8 a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12 a13 g1 g2 u1 "
        "y1 y2 y3 y4 y5 ml1 ml2 ml3 ml4 ml5 ml6 ml7 ml8 t1 t2 t3 ud1 c1 c2 c3 c4 c5 c6 c7"
    ).split()
    have = {name.split("_")[0] for name in queries()}
    assert [w for w in wanted if w not in have] == []
