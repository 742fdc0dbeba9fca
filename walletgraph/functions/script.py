"""Script and descriptor functions as Spark expressions; none leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of extended public keys.
EXTENDED_PREFIXES = ("xpub", "tpub", "ypub", "zpub", "vpub")

_STEP = r"/[0-9]+['h]?"
_HEX = "[0-9A-Fa-f]"
#: Key expressions of output descriptors, as their public grammar has them: an origin in brackets, then (group 2) an extended
#: key of any one-letter network with its path, a key in hex (compressed, uncompressed or x only), or a private key in Base58.
#: Steps are hardened by ' or h.
KEY_PATTERN = rf"(\[{_HEX}{{8}}(?:{_STEP})*\])?([A-Za-z](?:pub|prv)[0-9A-Za-z]+(?:{_STEP})*(?:/\*['h]?)?|(?:0[23]|04{_HEX}{{64}})?{_HEX}{{64}}|[1-9A-HJ-NP-Za-km-z]{{50,52}})"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_push_data(asm: Column | str) -> Column:
    """Tokens of a script that are data: all but operations."""
    tokens = F.split(F.trim(_column(asm)), r"\s+")
    return F.filter(tokens, lambda x: (x != "") & ~x.startswith("OP"))


def push_data_or_single(asm: Column | str) -> Column:
    """The only data token as a string, NULL if there are several or none."""
    tokens = parse_push_data(asm)
    return F.when(F.size(tokens) == 1, F.get(tokens, F.lit(0)))


def parse_desc(descriptor: Column | str) -> Column:
    """All keys of a descriptor, without origin and checksum; an empty array if it has none."""
    body = F.substring_index(F.translate(_column(descriptor), " ", ""), "#", 1)
    return F.regexp_extract_all(body, F.lit(KEY_PATTERN), F.lit(2))


def first_desc_key(descriptor: Column | str) -> Column:
    return F.get(parse_desc(descriptor), F.lit(0))


def is_extended_key(key: Column | str) -> Column:
    return F.substring(_column(key), 1, 4).isin(*EXTENDED_PREFIXES)


def compress_pubkey(key: Column | str) -> Column:
    """66 hex characters from an uncompressed key's 130; another key stays."""
    k = _column(key)
    odd = F.right(k, F.lit(1)).isin(*"13579bdfBDF")
    return F.when((F.length(k) == 130) & k.startswith("04"), F.concat(F.when(odd, "03").otherwise("02"), F.substring(k, 3, 64))).otherwise(k)


def revealed_key(witness: Column | str, asm: Column | str) -> Column:
    """The last item that a spending script pushes: of the witness, where there is one, else of the script."""
    w, a = _column(witness), _column(asm)
    return F.when(w.isNotNull(), F.trim(F.substring_index(w, ",", -1))).otherwise(F.trim(F.substring_index(a, " ", -1)))


def root_hash_v1(addresses: Column | str) -> Column:
    """SHA-256 of an address list written as a tuple of quoted strings; one address keeps the tuple's comma."""
    a = _column(addresses)
    body = F.concat(F.lit("('"), F.array_join(a, "', '"), F.when(F.size(a) == 1, "',)").otherwise("')"))
    return F.sha2(body, 256)


def keys_or_address(address: Column | str, descriptor: Column | str) -> Column:
    """The address alone if there is one, else the descriptor's keys."""
    a = F.nullif(_column(address), F.lit(""))
    return F.when(a.isNotNull(), F.array(a)).otherwise(parse_desc(descriptor))


def node_id(root: Column | str, address: Column | str, txid: Column | str, vout: Column | str) -> Column:
    """What stands for a spender: root of its address, else the address, else the spent output itself."""
    return F.coalesce(_column(root), F.nullif(_column(address), F.lit("")), F.concat(_column(txid), F.lit(":"), _column(vout).cast("bigint").cast("string")))


def packed(text: Column | str) -> Column:
    """A string as bytes, one for two characters of hex; for exchanges, which don't compress hex. Different strings stay different."""
    t = _column(text)
    is_hex = (F.length(t) % 2 == 0) & (F.translate(t, "0123456789abcdef", "") == "")
    return F.when(is_hex, F.concat(F.lit(b"\x00"), F.unhex(t))).otherwise(F.concat(F.lit(b"\x01"), t.cast("binary")))


def unpacked(data: Column | str) -> Column:
    """The string that packed() made these bytes of."""
    d = _column(data)
    rest = F.substring(d, 2, 1 << 30)
    return F.when(F.substring(d, 1, 1) == F.lit(b"\x00"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
