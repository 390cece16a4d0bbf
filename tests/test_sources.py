import pytest

from flowlens import Roles
from flowlens.functions.fixed import FLOW_FIELDS
from flowlens.sources import (
    default_taxonomy,
    normalize_columns,
    parse_events,
    read_blocklist,
    read_connections,
    read_dataset,
    read_event_stream,
    read_flows,
    read_taxonomy,
    rejected_connections,
    schema_from_names,
)

NAMES = [field.split()[0] for field in FLOW_FIELDS.split(",")]


def flow_line(**values):
    return ",".join(str(values.get(name, "")) for name in NAMES)


@pytest.fixture
def headerless(tmp_path):
    path = tmp_path / "flows.csv"
    path.write_text(
        flow_line(srcip="10.0.0.1", sport=80, dur=0.5, stcpb=4000000000, stime=1421927414,
                  attack_cat="DoS", label=1) + "\n"
        + flow_line(srcip="10.0.0.2", sport=22, label=0) + "\n"
        + "10.0.0.3,1\n"
    )
    return str(path)


@pytest.fixture
def with_header(tmp_path):
    path = tmp_path / "header.csv"
    path.write_text("srcip,Sload , Dst-Host Count,label\n10.0.0.1,1.5,3,0\n10.0.0.2,2.5,4,1\n")
    return str(path)


def test_fixed_schema(spark, headerless, rows):
    df = read_flows(spark, headerless)
    assert len(df.columns) == 50 and df.columns[-1] == "attack_category"
    kinds = dict(df.dtypes)
    assert (kinds["stcpb"], kinds["sport"], kinds["dur"]) == ("bigint", "int", "double")
    assert rows(df, "srcip", "stcpb", "attack_category", "label") == [
        ("10.0.0.1", 4000000000, "DoS", 1),
        ("10.0.0.2", None, "normal", 0),
        ("10.0.0.3", None, "normal", None),
    ]


def test_header_is_detected_and_types_inferred(spark, with_header, rows):
    df = read_flows(spark, with_header, declared_types=False)
    assert df.columns[:4] == ["srcip", "sload", "dst_host_count", "label"]
    assert dict(df.dtypes)["dst_host_count"] == "int"
    assert rows(df, "srcip", "sload") == [("10.0.0.1", 1.5), ("10.0.0.2", 2.5)]


def test_header_with_declared_types(spark, with_header, rows):
    df = read_flows(spark, with_header, declared_types=True)
    kinds = dict(df.dtypes)
    assert kinds["sload"] == "double" and kinds["dst_host_count"] == "string"
    assert rows(df, "srcip", "label") == [("10.0.0.1", 0), ("10.0.0.2", 1)]


def test_header_can_be_forced_off(spark, with_header):
    assert read_flows(spark, with_header, header=False).count() == 3


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], " `Src IP` int, `a-B ` int")
    assert normalize_columns(df).columns == ["src_ip", "a_b"]


NAMES_FILE = """back,normal,smurf.
duration: continuous.
protocol_type: symbolic.
src_bytes: continuous.
"""


@pytest.fixture
def connections(tmp_path):
    names = tmp_path / "names"
    names.write_text(NAMES_FILE)
    data = tmp_path / "data.csv"
    data.write_text("0,tcp,181,normal.\n2,udp,5.5,smurf.\n1,icmp,7,normal\n3,tcp,8,\n")
    return str(data), str(names)


def test_schema_from_names(spark, connections):
    schema = schema_from_names(spark, connections[1])
    assert schema.simpleString() == (
        "struct<duration:double,protocol_type:string,src_bytes:double,attack_type:string>"
    )


def test_connections(spark, connections, rows):
    df = read_connections(spark, *connections)
    assert rows(df, "protocol_type", "attack_type", "label") == [
        ("icmp", "normal", 0),
        ("tcp", "normal", 0),
        ("tcp", None, 1),
        ("udp", "smurf", 1),
    ]


def test_rejected_connections(spark, connections, rows):
    data, names = connections
    with open(data, "a") as file:
        file.write("4,tcp,many,normal.\n5,udp\n\n6,tcp,1,back.,more\n7,\"a,b\",2,back.\n")
    kept = read_connections(spark, data, names)
    assert kept.count() == 5 and kept.select("protocol_type").count() == 5
    assert rows(kept.where("duration = 7"), "protocol_type", "src_bytes", "attack_type") == [("a,b", 2.0, "back")]
    lost = rejected_connections(spark, data, names)
    assert rows(lost) == [("4,tcp,many,normal.",), ("5,udp",), ("6,tcp,1,back.,more",)]
    assert lost.count() == 3


def test_reader_by_name(spark, connections, headerless):
    assert read_dataset(spark, "KDDCUP99", connections[0], connections[1]).count() == 4
    assert read_dataset(spark, "unsw_nb15", headerless).count() == 3
    with pytest.raises(ValueError, match="unknown data set"):
        read_dataset(spark, "other", headerless)
    with pytest.raises(ValueError, match="names file"):
        read_dataset(spark, "kddcup99", connections[0])


def test_taxonomy(spark, tmp_path, rows):
    path = tmp_path / "types"
    path.write_text("back dos\nnmap\tprobe\n\nspy  r2l\n")
    assert rows(read_taxonomy(spark, str(path))) == [
        ("back", "dos"), ("nmap", "probe"), ("normal", "normal"), ("spy", "r2l"),
    ]


def test_built_in_taxonomy(spark):
    found = {r.attack: r.category for r in default_taxonomy(spark).collect()}
    assert len(found) == 23
    assert (found["normal"], found["rootkit"], found["satan"]) == ("normal", "u2r", "probe")


def test_blocklist(spark, tmp_path, rows):
    one, two = tmp_path / "one.txt", tmp_path / "two.txt"
    one.write_text("# comment\n\n10.0.0.1 extra words\n  10.0.0.2\n10.0.0\nhost.example\n")
    two.write_text("10.0.0.1\n999.1.1.1\n")
    assert rows(read_blocklist(spark, str(one), str(two))) == [
        ("10.0.0.1",), ("10.0.0.2",), ("999.1.1.1",),
    ]


def test_malformed_event_gives_nulls(spark, rows):
    good = '{"timestamp": "2024-01-01T00:00:01Z", "src_ip": "10.0.0.1", "src_bytes": 7}'
    parsed = parse_events(spark.createDataFrame([(good,), ("{oops",), ("",)], "value string"))
    assert len(parsed.columns) == 11
    assert rows(parsed, "src_ip", "src_bytes", "flag") == [
        ("10.0.0.1", 7, None), (None, None, None), (None, None, None),
    ]


def test_event_stream_from_text_files(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"src_ip": "10.0.0.9", "duration": 0.5}\n{bad\n')
    stream = read_event_stream(spark, "text", path=str(tmp_path / "in"))
    assert stream.isStreaming
    query = (
        stream.writeStream.format("memory").queryName("read_events")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("read_events"), "src_ip", "duration") == [
        ("10.0.0.9", 0.5), (None, None),
    ]


def test_roles(spark):
    df = spark.createDataFrame([], "srcip string, sbytes int, hour int, other int")
    roles = Roles.resolve(df)
    assert (roles.src, roles.src_bytes, roles.hour, roles.dst) == ("srcip", "sbytes", "hour", None)
    assert Roles.resolve(df, dst="other").dst == "other"
    assert roles.columns() == ["srcip", "sbytes", "hour"]
    with pytest.raises(ValueError, match="dst"):
        roles.need("src", "dst")
    with pytest.raises(ValueError, match="nowhere"):
        Roles.resolve(df, dst="nowhere")
