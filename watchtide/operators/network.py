"""Network findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchtide.functions.severity import severity_points
from watchtide.functions.text import classify, contains, first_match, has, is_false, not_empty
from watchtide.functions.variant import Read, with_reads
from watchtide.operators.geo import GEO_COLUMNS, GeoRanges, without_geo
from watchtide.settings import DEFAULTS, Settings

_CONNECTION = ".action.networkConnectionAction"
_REMOTE = _CONNECTION + ".remoteIpDetails"
_INSTANCE = ".instanceDetails"
_INTERFACE = _INSTANCE + ".networkInterfaces[0]"

# Terms and substrings of finding types that make a finding a network finding.
TYPE_TERMS = ("DNS", "Network", "Backdoor", "Trojan", "DDoS", "Port", "Tor", "Cryptocurrency", "Malware")
TYPE_PARTS = ("EC2/", "Behavior:")
# Category and the terms that select it, first match wins.
CATEGORIES = (
    ("Backdoor", ("Backdoor",)),
    ("Trojan", ("Trojan",)),
    ("DDoS", ("DDoS", "DenialOfService")),
    ("Anonymization", ("Tor",)),
    ("Cryptocurrency Mining", ("Cryptocurrency",)),
    ("DNS Abuse", ("DNS",)),
    ("Port Scanning", ("Port",)),
)
DEFAULT_CATEGORY = "Network Anomaly"
HOME_COUNTRY = "United States"
RECORD_SOURCE = "AWSGuardDuty_Network"

READS = (
    Read("ConnectionDirection", "service", _CONNECTION + ".connectionDirection"),
    Read("Protocol", "service", _CONNECTION + ".protocol"),
    Read("IsBlocked", "service", _CONNECTION + ".blocked", "boolean"),
    Read("LocalPort", "service", _CONNECTION + ".localPortDetails.port", "int"),
    Read("LocalPortName", "service", _CONNECTION + ".localPortDetails.portName"),
    Read("RemoteIp", "service", _REMOTE + ".ipAddressV4"),
    Read("RemoteIpV6", "service", _REMOTE + ".ipAddressV6"),
    Read("RemotePort", "service", _CONNECTION + ".remotePortDetails.port", "int"),
    Read("RemotePortName", "service", _CONNECTION + ".remotePortDetails.portName"),
    Read("RemoteCountry", "service", _REMOTE + ".country.countryName"),
    Read("RemoteCountryCode", "service", _REMOTE + ".country.countryCode"),
    Read("RemoteCity", "service", _REMOTE + ".city.cityName"),
    Read("RemoteLatitude", "service", _REMOTE + ".geoLocation.lat", "double"),
    Read("RemoteLongitude", "service", _REMOTE + ".geoLocation.lon", "double"),
    Read("RemoteOrganization", "service", _REMOTE + ".organization.org"),
    Read("RemoteIsp", "service", _REMOTE + ".organization.isp"),
    Read("RemoteAsn", "service", _REMOTE + ".organization.asn"),
    Read("RemoteAsnOrg", "service", _REMOTE + ".organization.asnOrg"),
    Read("InstanceId", "resource", _INSTANCE + ".instanceId"),
    Read("InstanceType", "resource", _INSTANCE + ".instanceType"),
    Read("InstanceState", "resource", _INSTANCE + ".instanceState"),
    Read("Platform", "resource", _INSTANCE + ".platform"),
    Read("LaunchTime", "resource", _INSTANCE + ".launchTime", "timestamp"),
    Read("AvailabilityZone", "resource", _INSTANCE + ".availabilityZone"),
    Read("ImageId", "resource", _INSTANCE + ".imageId"),
    Read("ImageDescription", "resource", _INSTANCE + ".imageDescription"),
    Read("NetworkInterfaceId", "resource", _INTERFACE + ".networkInterfaceId"),
    Read("VpcId", "resource", _INTERFACE + ".vpcId"),
    Read("SubnetId", "resource", _INTERFACE + ".subnetId"),
    Read("PrivateIp", "resource", _INTERFACE + ".privateIpAddress"),
    Read("PrivateDnsName", "resource", _INTERFACE + ".privateDnsName"),
    Read("PublicIp", "resource", _INTERFACE + ".publicIp"),
    Read("PublicDnsName", "resource", _INTERFACE + ".publicDnsName"),
    Read("SecurityGroupsText", "resource", _INTERFACE + ".securityGroups"),
)

NETWORK_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "FindingId",
    "FindingType",
    "ThreatCategory",
    "Severity",
    "SeverityLevel",
    "NetworkRiskScore",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "ConnectionDirection",
    "TrafficDirection",
    "Protocol",
    "IsBlocked",
    "LocalPort",
    "LocalPortName",
    "RemoteIp",
    "RemoteIpV6",
    "RemotePort",
    "RemotePortName",
    "RemoteCountry",
    "RemoteCountryCode",
    "RemoteCity",
    "RemoteLatitude",
    "RemoteLongitude",
    *GEO_COLUMNS,
    "RemoteOrganization",
    "RemoteIsp",
    "RemoteAsn",
    "RemoteAsnOrg",
    "InstanceId",
    "InstanceType",
    "InstanceState",
    "Platform",
    "LaunchTime",
    "AvailabilityZone",
    "ImageId",
    "ImageDescription",
    "NetworkInterfaceId",
    "VpcId",
    "SubnetId",
    "PrivateIp",
    "PrivateDnsName",
    "PublicIp",
    "PublicDnsName",
    "SecurityGroupIds",
    "ParserVersion",
    "RecordSource",
    "RawJson",
)


def is_network() -> Column:
    """Which rows of the base view are network findings."""
    kind = F.col("FindingType")
    wanted = (F.col("ActionType") == "NETWORK_CONNECTION") | has(kind, *TYPE_TERMS)
    for piece in TYPE_PARTS:
        wanted = wanted | contains(kind, piece)
    return wanted


def network_findings(base: DataFrame, geo: GeoRanges | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Connections seen by network findings, with category, direction and risk score.

    ``geo`` adds the looked-up place of the remote address; without it, or with geo
    enrichment switched off, those columns are empty.
    """
    kind = F.col("FindingType")
    rows = with_reads(base.filter(is_network()), READS)
    groups = F.regexp_extract_all("SecurityGroupsText", F.lit('"groupId":"([^"]+)"'), F.lit(1))
    direction = F.col("ConnectionDirection")
    country = F.col("RemoteCountry")
    typed = rows.withColumns(
        {
            "SecurityGroupIds": F.array_join(groups, ","),
            "TrafficDirection": first_match(
                [(direction == "INBOUND", "Inbound"), (direction == "OUTBOUND", "Outbound")], "Unknown"
            ),
            "ThreatCategory": classify(kind, CATEGORIES, DEFAULT_CATEGORY),
            "RecordSource": F.lit(RECORD_SOURCE),
        }
    ).withColumn(
        "NetworkRiskScore",
        severity_points(
            F.col("SeverityLevel"),
            (F.col("ThreatCategory").isin("Backdoor", "Trojan"), 20),
            (not_empty(country) & (country != HOME_COUNTRY), 10),
            (is_false(F.col("IsBlocked")), 10),
        ),
    )
    placed = geo.enrich(typed, "RemoteIp") if geo and settings.geo_enrichment else without_geo(typed)
    return placed.select(*NETWORK_COLUMNS)
