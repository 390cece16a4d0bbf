import datetime as dt

import pytest

from flowlens import Roles
from flowlens.operators import distribution as d


@pytest.fixture
def table(spark):
    base = dt.datetime(2024, 1, 7)
    data = [
        # hour offset, proto, service, src, port, label, category, bytes
        (0, "tcp", "http", 80, 1, "DoS", 500),
        (1, "tcp", "http", 80, 1, "DoS", 5000),
        (1, "udp", "dns", 53, 0, "normal", 50000),
        (25, "udp", "dns", 53, 0, "normal", 500000),
        (26, None, "-", 7, 0, None, 500),
    ]
    return spark.createDataFrame(
        [(base + dt.timedelta(hours=h), p, s, 1000 + i, port, lab, cat, b, 0)
         for i, (h, p, s, port, lab, cat, b) in enumerate(data)],
        "timestamp timestamp, proto string, service string, sport int, dsport int, label int, "
        "attack_category string, sbytes int, dbytes int",
    )


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_times(table):
    roles = Roles.resolve(table)
    assert ordered(d.hour_distribution(table, roles)) == [(0, 1), (1, 3), (2, 1)]
    assert ordered(d.weekday_distribution(table, roles)) == [(1, 3), (2, 2)]
    assert ordered(d.attack_hours(table, roles)) == [(0, 1), (1, 1)]


def test_largest_first_and_ties_by_key(table):
    roles = Roles.resolve(table)
    assert ordered(d.protocol_distribution(table, roles)) == [("tcp", 2), ("udp", 2), (None, 1)]
    assert ordered(d.protocol_attack_relation(table, roles)) == [
        ("tcp", "DoS", 2), ("udp", "normal", 2), (None, None, 1),
    ]
    assert ordered(d.label_distribution(table, roles)) == [(0, 3), (1, 2)]
    assert ordered(d.category_distribution(table, roles)) == [
        ("DoS", 2), ("normal", 2), (None, 1),
    ]


def test_services_are_limited(table):
    roles = Roles.resolve(table)
    assert ordered(d.service_distribution(table, roles, k=1)) == [("dns", 2)]
    assert len(ordered(d.service_distribution(table, roles))) == 3


def test_ports(table, rows):
    found = rows(d.port_distribution(table, Roles.resolve(table), k=2))
    assert found == [
        ("dsport", "53", 2, 1), ("dsport", "80", 2, 2), ("sport", "1000", 1, 1),
        ("sport", "1001", 1, 2),
    ]


def test_segments(table):
    found = ordered(d.segment_distribution(table, Roles.resolve(table)))
    assert [(name[0], n) for name, n in found] == [("小", 2), ("中", 1), ("大", 1), ("超", 1)]


def test_cells_give_the_same_distributions(table):
    roles = Roles.resolve(table)
    cells = d.cell_counts(table, roles)
    of_cells = Roles.resolve(cells)
    for report in (
        d.hour_distribution, d.weekday_distribution, d.attack_hours, d.protocol_distribution,
        d.protocol_attack_relation, d.service_distribution, d.label_distribution,
        d.category_distribution, d.segment_distribution,
    ):
        assert ordered(report(cells, of_cells, weight=d.ROWS)) == ordered(report(table, roles)), report.__name__


def test_missing_role_is_named(table):
    with pytest.raises(ValueError, match="service"):
        d.service_distribution(table.drop("service"), Roles.resolve(table.drop("service")))


def test_empty_input(table):
    roles = Roles.resolve(table)
    empty = table.filter("false")
    assert ordered(d.hour_distribution(empty, roles)) == []
    assert ordered(d.port_distribution(empty, roles)) == []


def test_top_k_is_a_bounded_sort(table):
    plan = d.service_distribution(table, Roles.resolve(table))._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()
