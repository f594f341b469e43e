"""Base58 encoding, which Spark lacks: an Arrow-batched function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the usual alphabet without 0, O, I and l.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


#: So many characters are split off at a time, as whole numbers of any length are slow to divide.
_STEP = 58**10


def encode(raw: bytes | None) -> str | None:
    if raw is None:
        return None
    raw = bytes(raw)
    n, out = int.from_bytes(raw, "big"), []
    while n:
        n, part = divmod(n, _STEP)
        for _ in range(10):
            part, r = divmod(part, 58)
            out.append(ALPHABET[r])
    return ALPHABET[0] * (len(raw) - len(raw.lstrip(b"\0"))) + "".join(reversed(out)).lstrip(ALPHABET[0])


@F.pandas_udf(T.StringType())
def base58(raw: pd.Series) -> pd.Series:
    known = {x: encode(x) for x in raw.dropna().unique()}
    return raw.map(known, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def base58_array(raw: pd.Series) -> pd.Series:
    """Each distinct value is encoded once for a batch; accounts recur in most transactions."""
    known: dict[bytes | None, str | None] = {None: None}

    def one(xs):
        out = []
        for x in xs:
            if x not in known:
                known[x] = encode(x)
            out.append(known[x])
        return out

    return raw.map(one, na_action="ignore")
