from pyspark.sql import functions as F

from walletgraph.functions import registry
from walletgraph.functions import script as S

K1 = "0279be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798"
K2 = "022f8bde4d1a07209355b4a7250a5c5128e88b84bddc619ab7cba8d569b240efe4"
K3 = "025cbdf0646e5db4eaa398f365f2ea7a0e3d419b7e0330e39ce92bddedcac4f9bc"
X1 = "c6047f9441ed7d6d3045406e95c07cd85c778e4b8cef3ca7abac09b95c709ee5"
X2 = "fff97bd5755eeea420453a14355235d382f6472f8568a18b2f057a1460297556"
XPUB = "xpub69H7F5d8KSRgmmdJg2KhpAK8SR3DjMwAdkxj3ZuxV27CprR9LgpeyGmXUbC6wb7ERfvrnKZjXoUmmDznezpbZb7ap6r1D3tgFxHmwMkQTPH"
LONG = "0496b538e853519c726a2c91e61ec11600ae1390813a627c66fb8be7947be63c52da7589379515d4e0a604f8141781e62294721166bf621e73a82cbf2342c858ee"


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


def test_parse_desc(spark):
    cases = {
        f"pk({K1})": [K1],
        f"multi(2,{K2},{K3})": [K2, K3],
        f"multi(2, {K2}, {K3})": [K2, K3],
        f"pkh([d34db33f/44'/0'/0']{XPUB}/1/*)": [XPUB + "/1/*"],
        f"tr({X1},{{pk({X2})}})": [X1, X2],
        f"wpkh({XPUB}/0/*)": [XPUB + "/0/*"],
        f"sh(wpkh({K1}))#abcd1234": [K1],
        f"pk({LONG})": [LONG],
        "zpub" + XPUB[4:]: ["zpub" + XPUB[4:]],
        "addr(none)": [],
        "": [],
    }
    for text, keys in cases.items():
        assert one(spark, S.parse_desc("d"), d=text) == keys, text
        assert one(spark, S.first_desc_key("d"), d=text) == (keys[0] if keys else None)
    assert one(spark, S.parse_desc("d"), d=None) is None


def test_push_data(spark):
    three = [LONG[:-1] + c for c in "abc"]
    cases = {
        f"{LONG} OP_CHECKSIG": [LONG],
        "OP_2 " + " ".join(f"OP_PUSHBYTES_65 {k}" for k in three) + " OP_3 OP_CHECKMULTISIG": three,
        "  ": [],
        "": [],
    }
    for asm, tokens in cases.items():
        assert one(spark, S.parse_push_data("a"), a=asm) == tokens
    assert one(spark, S.push_data_or_single("a"), a=f"{LONG} OP_CHECKSIG") == LONG
    assert one(spark, S.push_data_or_single("a"), a="OP_1 aa bb") is None


def test_revealed_key(spark):
    cases = [(("sig, key", "x y"), "key"), ((None, "sig  key"), "key"), ((None, None), None), (("", "x"), ""), (("a,", None), ""), (("only", None), "only")]
    for (w, a), key in cases:
        assert one(spark, S.revealed_key("w", "a"), w=w, a=a) == key


def test_small_functions(spark):
    assert one(spark, S.compress_pubkey("k"), k=LONG) == "02" + LONG[2:66]
    assert one(spark, S.compress_pubkey("k"), k=LONG[:-1] + "d") == "03" + LONG[2:66]
    assert one(spark, S.compress_pubkey("k"), k=K1) == K1
    assert one(spark, S.is_extended_key("k"), k=XPUB) and not one(spark, S.is_extended_key("k"), k=K1)
    import hashlib

    for a in (["x", "y"], ["x"]):
        assert one(spark, S.root_hash_v1(F.split("a", ",")), a=",".join(a)) == hashlib.sha256(str(tuple(a)).encode()).hexdigest()
    assert one(spark, S.keys_or_address("a", "d"), a="", d=f"pk({K1})") == [K1]
    assert one(spark, S.keys_or_address("a", "d"), a="addr", d=f"pk({K1})") == ["addr"]
    assert one(spark, S.node_id("r", "a", "t", "v"), r=None, a="", t="tx", v="0") == "tx:0"


def test_sql_names(spark):
    registry.register(spark)
    row = spark.sql(f"SELECT parse_desc('pkh([d34db33f/44\\'/0\\']{K1})') AS a, parse_push_data('OP_1 x') AS b, revealed_key('s, k', NULL) AS c, is_extended_key('{XPUB}') AS d, size(derive_addresses('{K1}')) AS e").first()
    assert tuple(row) == ([K1], ["x"], "k", True, 5)
