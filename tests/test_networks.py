"""Addresses of both families, and the longest network that holds one."""

import ipaddress
import random

from pyspark.sql import functions as F

from gatewarden.functions.networks import address_hex, longest_networks, with_prefixes
from gatewarden.operators.network_zones import zone_activity
from tests.sample_star import event, star, tuples

TEXTS = [
    "1.2.3.4", "255.255.255.255", "0.0.0.0", "::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4",
    "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "fe80::1%eth0", "1.2.3", "1.2.3.256", "01.2.3.4", ":", ":::",
    "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "12345::", "g::", "", "1.2.3.4:5", "::1.2.3.300", "1:2:3:4:5:6:7:1.2.3.4", ":1:2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7:", "a:b", "::ffff:1.2.3.4.5",
]


def value(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    if "%" in text:
        return None
    return f"{int(address) + (0xFFFF << 32 if address.version == 4 else 0):032x}"


def test_addresses_as_digits(spark):
    dice = random.Random(4)
    made = [str(ipaddress.IPv6Address(dice.getrandbits(128) & dice.getrandbits(128) & ~(0xFFFF << 16 * dice.randint(0, 7)))) for _ in range(300)]
    made += [ipaddress.ip_address(m).exploded for m in made[:50]] + [str(ipaddress.IPv4Address(dice.getrandbits(32))) for _ in range(50)]
    frame = spark.createDataFrame([(t,) for t in TEXTS + made + [None]], "t string")
    found = {r["t"]: r["d"] for r in frame.select("t", address_hex(F.col("t")).alias("d")).collect()}
    assert found == {t: value(t) if t is not None else None for t in TEXTS + made + [None]}


def test_ten_thousand_networks_of_both_families(spark):
    dice = random.Random(6)
    networks = {"0.0.0.0/0", "10.0.0.0/8", "::/0", "2001:db8::/32"}
    while len(networks) < 10_000:
        if dice.random() < 0.5:
            networks.add(f"10.{dice.randint(0, 255)}.{dice.randint(0, 255)}.0/{dice.randint(9, 32)}")
        else:
            networks.add(f"2001:db8:{dice.randint(0, 60):x}:{dice.randint(0, 99):x}::/{dice.randint(33, 128)}")
    addresses = [f"10.{dice.randint(0, 255)}.{dice.randint(0, 255)}.{dice.randint(0, 3)}" for _ in range(200)]
    addresses += [f"2001:db8:{dice.randint(0, 60):x}:{dice.randint(0, 99):x}::{dice.randint(0, 3):x}" for _ in range(200)]
    addresses += ["192.0.2.1", "fe80::1", "nowhere"]
    table = spark.createDataFrame([(n,) for n in sorted(networks)] + [("bad/9",), ("10.0.0.0/33",), ("10.0.0.0/8/1",)], "network string")
    frame = spark.createDataFrame([(a,) for a in addresses * 2], "source_ip string")
    found = longest_networks(frame, table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "HashJoin" in plan
    parsed = [(ipaddress.ip_network(n, strict=False), n) for n in networks]
    got = dict(tuples(found))
    assert len(got) == len(set(addresses)) == found.count()
    for text in set(addresses[::7] + ["192.0.2.1", "fe80::1"]):
        address = ipaddress.ip_address(text)
        inside = [(net, n) for net, n in parsed if net.version == address.version and address in net]
        longest = max(net.prefixlen for net, _ in inside)
        assert got[text] == min(n for net, n in inside if net.prefixlen == longest)
    assert got["nowhere"] is None


def test_prefixes(spark):
    rows = [("10.0.0.1",), ("::1",), ("10.0.0.1/8",), ("x",), ("::/129",), ("1.2.3.4/",), (None,)]
    found = with_prefixes(spark.createDataFrame(rows, "network string"))
    assert sorted(tuples(found, "network", "length")) == [("10.0.0.1", 128), ("10.0.0.1/8", 104), ("::1", 128)]
    none = spark.createDataFrame([], "network string")
    assert tuples(longest_networks(spark.createDataFrame([("::1",)], "source_ip string"), none)) == [("::1", None)]


def test_zones(spark):
    rows = [
        event(1, 1, 1, "10.0.0.1", "F", "2025-01-20 10:00:00"), event(2, 2, 1, "10.0.0.1", "S", "2025-01-20 10:00:00"),
        event(3, 1, 1, "10.0.0.2", "F", "2025-01-20 10:00:00"), event(4, 1, 1, "2001:db8::1", "F", "2025-01-20 10:00:00"),
        event(5, 1, 1, "bad", "F", "2025-01-20 10:00:00"),
    ]
    networks = spark.createDataFrame(
        [("10.0.0.0/8", "office", True), ("10.0.0.2/32", "guest", False), ("2001:db8::/32", "office6", True)],
        "network string, zone string, is_internal boolean",
    )
    assert tuples(zone_activity(star(spark, events=rows), networks)) == [
        ("10.0.0.0/8", "office", True, 2, 1, 1, 2), ("10.0.0.2/32", "guest", False, 1, 1, 1, 1),
        ("2001:db8::/32", "office6", True, 1, 1, 1, 1), (None, "unlisted", False, 1, 1, 1, 1),
    ]
