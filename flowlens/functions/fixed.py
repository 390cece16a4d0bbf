"""Values that results depend on, stated as they are."""

# Names in the label columns.
NORMAL = "normal"
NORMAL_NAMES = ("normal", "Normal")
UNKNOWN = "unknown"

# Attack names counted as denial of service and as probing.
DOS_NAMES = ("neptune", "smurf", "pod", "teardrop", "back", "land", "DoS")
PROBE_NAMES = ("ipsweep", "nmap", "portsweep", "satan", "Reconnaissance", "Analysis")

# Attack name and category.
TAXONOMY = """
normal normal
back dos
buffer_overflow u2r
ftp_write r2l
guess_passwd r2l
imap r2l
ipsweep probe
land dos
loadmodule u2r
multihop r2l
neptune dos
nmap probe
perl u2r
phf r2l
pod dos
portsweep probe
rootkit u2r
satan probe
smurf dos
spy r2l
teardrop dos
warezclient r2l
warezmaster r2l
"""

# Upper bounds (exclusive) and names of the traffic segments.
SEGMENTS = (
    (1000, "小流量(<1KB)"),
    (10000, "中流量(1-10KB)"),
    (100000, "大流量(10-100KB)"),
    (None, "超大流量(>100KB)"),
)

# Shape of a dotted IPv4 address.
IPV4_SHAPE = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"

# Separator, length and shortest kept text of event sequences.
SEQUENCE_SEPARATOR = "->"
SEQUENCE_STEPS = 6
SEQUENCE_MIN_CHARS = 10

# Alert levels, reasons and default thresholds.
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
REASONS = {
    HIGH: "Possible DDoS attack detected",
    MEDIUM: "Suspicious traffic pattern",
    LOW: "Normal",
}
FLOOD_CONNECTIONS, FLOOD_DURATION = 1000, 0.1
HEAVY_BYTES, HEAVY_CONNECTIONS = 10000, 100

# Columns of the flow table, in file order.
FLOW_FIELDS = """
srcip string, sport int, dstip string, dsport int, proto string, state string,
dur double, sbytes int, dbytes int, sttl int, dttl int, sloss int, dloss int,
service string, sload double, dload double, spkts int, dpkts int, swin int,
dwin int, stcpb bigint, dtcpb bigint, smeansz int, dmeansz int,
trans_depth int, res_bdy_len int, sjit double, djit double, stime bigint,
ltime bigint, sintpkt double, dintpkt double, tcprtt double, synack double,
ackdat double, is_sm_ips_ports int, ct_state_ttl int, ct_flw_http_mthd int,
is_ftp_login int, ct_ftp_cmd int, ct_srv_src int, ct_srv_dst int,
ct_dst_ltm int, ct_src_ltm int, ct_src_dport_ltm int, ct_dst_sport_ltm int,
ct_dst_src_ltm int, attack_cat string, label int
"""

# Fields of one event on the stream.
EVENT_FIELDS = """
timestamp timestamp, src_ip string, dst_ip string, src_port int, dst_port int,
protocol string, packet_size int, flag string, duration double,
src_bytes int, dst_bytes int
"""
