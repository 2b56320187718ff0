"""Decisions of a transport, as columns and plain functions: addresses, redirects, retries.  Fetching is a provider's."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loomwick.functions.url import origin, part, scheme
from loomwick.types import plain

#: Networks whose addresses hold another IPv4 address.
EMBEDDING = [ipaddress.ip_network(n) for n in ("64:ff9b::/96", "64:ff9b:1::/48", "2002::/16", "2001::/32")]
#: Fixed value: a block of protocol addresses, none of them a host's, though Python counts some as global (192.0.0.9).
PROTOCOLS = ipaddress.ip_network("192.0.0.0/24")
#: Statuses that mean a block, a retry, a redirect.
BLOCKED, RETRY, REDIRECT = [401, 403, 407, 418, 429, 451, 503], [429, 500, 502, 503, 504], [301, 302, 303, 307, 308]
MAX_REDIRECTS = 5


def is_public(address: str | None) -> bool:
    try:
        ip = ipaddress.ip_address((address or "").split("%", 1)[0])
    except ValueError:
        return False
    ip = getattr(ip, "ipv4_mapped", None) or ip
    return ip.is_global and not ip.is_multicast and not (any(ip in n for n in EMBEDDING) if ip.version == 6 else ip in PROTOCOLS)


@pandas_udf(plain("boolean"))
def public_address(addresses: pd.Series) -> pd.Series:
    return addresses.map(is_public)


def public_addrs(resolved):
    """(host, address) rows to one row a host: its addresses, IPv4 first; empty if any is not public."""
    known = resolved.dropDuplicates(["host", "address"]).withColumn("public", public_address("address"))
    entry = F.struct(F.contains("address", F.lit(":")).alias("v6"), F.col("address"))
    ordered = F.transform(F.array_sort(F.collect_set(entry)), lambda e: e["address"])
    return known.groupBy("host").agg(F.when(F.bool_and("public"), ordered).otherwise(F.array().cast("array<string>")).alias("addresses"))


def target(url: Column) -> Column:
    """struct(host, port) of an http(s) address without credentials, else null."""
    o = origin(url)
    fine = scheme(url).isin("http", "https") & (o["host"] != "") & ~F.contains(part(url, 3), F.lit("@"))
    return F.when(fine, F.struct(o["host"].alias("host"), o["port"].alias("port")))


def same_origin(a: Column, b: Column) -> Column:
    return origin(a) == origin(b)


def after_redirect(status: Column, method: Column) -> Column:
    """The method of the next request: 301, 302 and 303 turn a POST into a GET."""
    return F.when(status.isin(301, 302, 303) & (method == "POST"), "GET").otherwise(method)


def retry_delay(attempt: Column, retry_after: Column) -> Column:
    """Seconds before another try: what the server asks, 30 at most, else 0.8 doubled for each attempt."""
    asked = retry_after.try_cast("double")
    return F.when(asked.isNotNull(), F.least(F.greatest(asked, F.lit(0.0)), F.lit(30.0))).otherwise(0.8 * F.pow(F.lit(2.0), attempt - 1))


def status_class(status: Column) -> Column:
    return (
        F.when(status.isin(REDIRECT), "redirect").when(status.isin(404, 410), "gone").when(status.isin(BLOCKED), "blocked")
        .when(status.isin(RETRY), "retry").when(status.between(200, 299), "ok").otherwise("failed")
    )
