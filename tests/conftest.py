from __future__ import annotations

import copy
import json
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

AS_OF = datetime(2025, 3, 19, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def finding():
    """A network finding with every member the network view reads."""
    return copy.deepcopy(FULL)


@pytest.fixture
def small_finding():
    """The same finding with the least nesting, as event envelopes carry it."""
    return copy.deepcopy(SMALL)


def envelope(detail, **changes):
    event = {"version": "0", "id": "ev", "detail-type": "GuardDuty Finding", "source": "aws.guardduty", "detail": detail}
    event |= {"account": "210987654321", "region": "eu-central-1", "time": "2025-03-18T20:00:00Z", "resources": []}
    event.update(changes)
    return event


def lines(spark, *documents):
    """Documents as parsed export lines; a string is taken as the raw line."""
    from watchtide.sources.exports import parse_lines

    raw = [(d if isinstance(d, str) else json.dumps(d, ensure_ascii=False),) for d in documents]
    return parse_lines(spark.createDataFrame(raw, "raw STRING"))


def unwrapped(spark, *documents):
    from watchtide.sources.exports import explode_batches, unwrap_events

    return unwrap_events(explode_batches(lines(spark, *documents)))


def table(spark, *documents):
    from watchtide.sources.table import to_findings_table

    return to_findings_table(unwrapped(spark, *documents))


def base(spark, *documents, lookback="7d", **options):
    from watchtide.operators.base import base_findings

    return base_findings(table(spark, *documents), lookback, AS_OF, **options)


def interface(number, **more):
    return {"networkInterfaceId": f"eni-{number}", "privateIpAddress": f"172.31.5.{number}", **more}


def instance(*interfaces, **more):
    return {"resourceType": "Instance", "instanceDetails": {"instanceId": "i-77", "instanceType": "m6g.large", "networkInterfaces": list(interfaces), **more}}


def connection(local, remote, address, country, **more):
    sides = {"localPortDetails": {"port": local}, "remotePortDetails": {"port": remote}}
    place = {"ipAddressV4": address, "country": {"countryName": country}}
    return {"actionType": "NETWORK_CONNECTION", "networkConnectionAction": {"protocol": "UDP", "connectionDirection": "INBOUND", "remoteIpDetails": place, **sides, **more}}


def trojan_finding(resource, action):
    """A drop point that a host in Brazil keeps reading from; the second interface has an IPv6 address only."""
    seen = {"eventFirstSeen": "2025-03-17T23:59:58.250Z", "eventLastSeen": "2025-03-18T04:05:06.125Z"}
    return {
        "schemaVersion": "2.0",
        "id": "f1",
        "type": "Trojan:EC2/DropPoint",
        "severity": 7.3,
        "accountId": "210987654321",
        "region": "eu-central-1",
        "partition": "aws",
        "arn": "arn:aws:guardduty:eu-central-1:210987654321:detector/dt-9/finding/f1",
        "title": "Traffic to a drop point",
        "description": "An outside host reads data that was left on an instance.",
        "createdAt": "2025-03-18T04:06:00.500Z",
        "updatedAt": "2025-03-18T19:30:45.123456Z",
        "service": {"serviceName": "guardduty", "detectorId": "dt-9", "action": action, **seen},
        "resource": resource,
    }


FULL = trojan_finding(
    instance(
        interface(20, vpcId="vpc-main", subnetId="subnet-b", securityGroups=[{"groupId": "sg-web", "groupName": "web"}, {"groupId": "sg-ops", "groupName": "ops"}]),
        {"networkInterfaceId": "eni-21", "ipv6Addresses": ["2001:db8::21"]},
        platform="linux",
        launchTime="2025-02-01T08:15:00.000Z",
        instanceState="running",
    ),
    connection(40000, 53, "198.18.7.21", "Brazil", blocked=False),
)
SMALL = trojan_finding(instance({"privateIpAddress": "172.31.5.20", "vpcId": "vpc-main"}, platform="linux"), connection(40000, 53, "198.18.7.21", "Brazil"))
