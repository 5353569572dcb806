"""Addresses and identifiers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Host without port and without a leading ``www.``; empty if the address has none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:www\.)?([^/?#:]+)", 1)


def registered_domain(url: Column) -> Column:
    """The last two labels of the host."""
    labels = F.split(host(url), r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def segment(url: Column, n: int) -> Column:
    """The n-th part between slashes, from 0; null if there is none."""
    return F.get(F.split(url, "/"), F.lit(n))


def segment_count(url: Column) -> Column:
    return F.size(F.split(url, "/"))


def site_key(url: Column) -> Column:
    """What makes two requests the same: everything but scheme and fragment."""
    return F.regexp_replace(without_fragment(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")


def absolute_image(url: Column, domain: Column) -> Column:
    """An image address made absolute: protocol-relative gets a protocol, root-relative the domain."""
    return F.when(url.startswith("//"), F.concat(F.lit("http:"), url)).when(url.startswith("/"), F.concat(domain, url)).otherwise(url)


def resolve(base: Column, ref: Column) -> Column:
    """A reference resolved against an absolute address; ``..`` and ``.`` are kept as they are."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(without_fragment(base), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref)
        .when(ref.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref == "", base)
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), ref))
    )


def decoded(text: Column) -> Column:
    """Percent-decoding that leaves a plus sign alone; null if it can't be decoded."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def signed_crc(text: Column) -> Column:
    """CRC-32 as a signed number in decimal digits."""
    c = F.crc32(F.encode(text, "UTF-8"))
    return F.when(c >= 2**31, c - 2**32).otherwise(c).cast("string")


def is_hex(s: Column) -> Column:
    return s.rlike("^[0-9a-fA-F]*$")


def is_base32(s: Column) -> Column:
    return s.rlike("^[A-Za-z2-7]*$")


def is_digest(s: Column) -> Column:
    """40 hexadecimal digits or 32 of base 32."""
    return s.rlike("^(?:[0-9a-fA-F]{40}|[A-Za-z2-7]{32})$")


def is_ugly_id(s: Column) -> Column:
    """Whether an element id has more than three digits and underscores."""
    return F.length(F.regexp_replace(s, "[^0-9_]", "")) > 3


def squeezed(s: Column) -> Column:
    """Control characters that break rows become spaces."""
    return F.regexp_replace(s, "[\t\n\r\f\x0b]", " ")


def base32_to_hex(s: Column) -> Column:
    """Hexadecimal digits of a digest in base 32 (capitals), by arithmetic on the code points."""
    chars = F.split(F.upper(s), "")
    bits = F.array_join(F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.lpad(F.bin(F.instr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), c) - 1), 5, "0")), "")
    nibbles = F.regexp_extract_all(bits, F.lit("([01]{4})"), F.lit(1))
    return F.array_join(F.transform(nibbles, lambda b: F.conv(b, 2, 16)), "")


def canonical_digest(s: Column) -> Column:
    """A digest in 40 hexadecimal capitals, told apart by its length; null for anything else."""
    return F.when(F.length(s) == 40, F.upper(s)).when((F.length(s) == 32) & is_base32(s), base32_to_hex(s))


# Media types of files to decode and of files to pass over.
DECODED = ("application/x-bittorrent", "application/octet-stream")
DROPPED = ("text/css", "image/gif", "image/png", "text/javascript")


def route(url: Column, media_type: Column) -> Column:
    """What becomes of a response: magnet, decode, drop or continue; a type that is missing continues."""
    kind = F.lower(F.trim(F.split_part(media_type, F.lit(";"), F.lit(1))))
    return F.when(url.startswith("magnet:"), "magnet").when(kind.isin(*DECODED), "decode").when(kind.isin(*DROPPED), "drop").otherwise("continue")
