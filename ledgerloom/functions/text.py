"""Hashing, network masking, hub keys and other string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(\.{_OCTET}){{3}}"
_IPV4 = rf"\A{_DOTTED}\z"


def _ipv6_pattern() -> str:
    """Eight groups, or fewer around one ``::``; the last two may be a dotted address."""
    h = "[0-9a-fA-F]{1,4}"
    forms = [f"({h}:){{7}}{h}", f"({h}:){{6}}{_DOTTED}"]
    for left in range(8):
        head = f"{h}(:{h}){{{left - 1}}}" if left else ""
        room = 7 - left
        forms.append(f"{head}::" + (f"({h}(:{h}){{0,{room - 1}}})?" if room else ""))
        if room >= 2:
            forms.append(f"{head}::({h}:){{0,{room - 2}}}{_DOTTED}")
    return rf"\A({'|'.join(forms)})(%[^%/]+)?\z"


_IPV6 = _ipv6_pattern()


def sha256_hex(col: Column) -> Column:
    """SHA-256 of the string form; NULL stays NULL."""
    return F.sha2(col.cast("string"), 256)


def _ipv6_network(col: Column) -> Column:
    """First 24 bits of an IPv6 address in compressed form, from its first two groups."""
    bare = F.split_part(col, F.lit("%"), F.lit(1))
    short = bare.contains("::")
    left = F.split(F.split_part(bare, F.lit("::"), F.lit(1)), ":")
    right = F.split(F.split_part(bare, F.lit("::"), F.lit(2)), ":")
    # With "::" the second group is explicit only when two groups precede it, or when seven
    # follow a leading "::"; a dotted tail counts as two groups.
    follow = F.size(right) + F.when(bare.contains("."), 1).otherwise(0)
    first = F.get(left, F.lit(0))
    second = F.when(F.size(left) >= 2, F.get(left, F.lit(1))).when(
        short & (first == "") & (follow == 7), F.get(right, F.lit(0))
    )
    number = lambda g: F.coalesce(F.conv(F.nullif(g, F.lit("")), 16, 10).cast("long"), F.lit(0).cast("long"))
    g1, g2 = number(first), number(second).bitwiseAND(F.lit(0xFF00))
    text = (
        F.when((g1 == 0) & (g2 == 0), F.lit("::"))
        .when(g2 == 0, F.concat(F.lower(F.hex(g1)), F.lit("::")))
        .otherwise(F.concat(F.lower(F.hex(g1)), F.lit(":"), F.lower(F.hex(g2)), F.lit("::")))
    )
    return F.when(col.rlike(_IPV6), F.concat(text, F.lit("/24")))


def ip_network(col: Column) -> Column:
    """The /24 network of an IPv4 or IPv6 address; NULL for a missing or invalid one."""
    v4 = F.when(col.rlike(_IPV4), F.concat(F.substring_index(col, ".", 3), F.lit(".0/24")))
    return F.coalesce(v4, _ipv6_network(col))


def hub_key(prefix: str, *parts: Column) -> Column:
    """``prefix:part:part``; NULL as soon as one part is NULL."""
    pieces = [F.lit(prefix)]
    for part in parts:
        pieces += [F.lit(":"), part.cast("string")]
    return F.concat(*pieces)


def hub_key_keep_null(prefix: str, *parts: Column) -> Column:
    """As :func:`hub_key`, but a missing part becomes the text ``nan``."""
    return hub_key(prefix, *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def node_type(col: Column) -> Column:
    return F.when(col.startswith("client_"), "client").otherwise("community")


def ordered_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """The two ids in ascending byte order."""
    return F.least(a, b), F.greatest(a, b)
