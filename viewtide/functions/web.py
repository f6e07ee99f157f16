"""IP addresses, URLs and user agents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OCTET = r"(25[0-5]|2[0-4]\d|[01]?\d?\d)"
DOTTED_QUAD = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"

# Fixed values, in order: the first pattern found in the user agent names the family.
BROWSERS = [
    ("Edg/", "Edge"),
    ("Firefox/", "Firefox"),
    ("Chrome/", "Chrome"),
    ("Safari/", "Safari"),
]
SYSTEMS = [
    ("Windows NT", "Windows"),
    ("iPhone|iPad", "iOS"),
    ("Android", "Android"),
    ("Linux", "Linux"),
]


def ipv4_number(ip: Column) -> Column:
    """Dotted quad as a number; NULL when it is not four octets of at most 255."""
    octets = [F.split_part(ip, F.lit("."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    number = octets[0]
    for octet in octets[1:]:
        number = number * 256 + octet
    return F.when(ip.rlike(DOTTED_QUAD), number)


def url_host(url: Column) -> Column:
    """Host of a URL; NULL when the text is not a URL."""
    return F.try_parse_url(url, F.lit("HOST"))


def _first_match(text: Column, rules: list[tuple[str, str]]) -> Column:
    family = None
    for pattern, name in rules:
        hit = text.rlike(pattern)
        family = F.when(hit, name) if family is None else family.when(hit, name)
    return family.otherwise("Other")


def browser_family(user_agent: Column) -> Column:
    return _first_match(user_agent, BROWSERS)


def os_family(user_agent: Column) -> Column:
    return _first_match(user_agent, SYSTEMS)
