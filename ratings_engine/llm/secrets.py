"""Secret scan with multipart credential linking.

Strong spans (assignments, access identifiers, long hex) are always reported.
Weak candidates -- something that could be an identifier, a secret or an
endpoint -- mean little alone. They are joined by interval within a scope: each
part reaches ``SCOPE`` code points to either side, but not across a blank line,
and a weak candidate is reported only if the parts that complete it reach it:

    weak secret    needs an identifier or an endpoint
    weak identifier needs a secret
    weak endpoint  needs a secret and an identifier

Strong spans serve as parts (access = identifier; assign, hex = secret).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import Cover, digest, in_order
from .text import map_batches

SCOPE = 800
BLANK = re.compile(r"\n(?:[\x20\t\r]*\n)+")

# Fixed patterns of the base kinds; the letters of the key names in either case.
KEY = re.compile(r"(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in
                                   ("password", "passwd", "secret", "token", "api_?key")) + r")"
                 r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# Weak candidates: a named identifier, a mixed token, a URL or host with port or a named endpoint.
WEAK_ID = re.compile(r"""\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""", re.I | re.A)
WEAK_SECRET = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WEAK_ENDPOINT = re.compile(r"""\b(?:(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqp|s3)://[^\s"'<>]{3,}|(?:host|server|endpoint|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}(?::[0-9]{2,5})?)""", re.I | re.A)


def strong_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    assign = [m.span() for m in KEY.finditer(text) if m.end(1) - m.start(1) >= 6]
    access = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 20] if "AKIA" in text else []
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def _mixed(token: str) -> bool:
    """Digits and letters of 3.5 bits a character or more, as generated keys have."""
    if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= 3.5


def linked_spans(text: str, strong: dict, scope: int = SCOPE) -> dict[str, list[tuple[int, int]]]:
    """Weak candidates completed by their complementary parts within ``scope`` code points (empty lists otherwise)."""
    taken = Cover(s for spans in strong.values() for s in spans)
    free = lambda spans: [s for s in spans if not taken.meets(*s)]
    secrets = free(m.span() for m in WEAK_SECRET.finditer(text) if _mixed(m[0]))
    if not secrets and not strong["assign"] and not strong["hex"]:
        return {"weak_id": [], "weak_secret": [], "weak_endpoint": []}
    ids, ends = free(m.span() for m in WEAK_ID.finditer(text)), free(m.span() for m in WEAK_ENDPOINT.finditer(text))
    named = Cover(ids + ends)
    secrets = [s for s in secrets if not named.meets(*s)]
    gaps = [m.span() for m in BLANK.finditer(text)]
    starts, stops = [0, *(e for _, e in gaps)], [*(s for s, _ in gaps), len(text)]

    def reach(spans):
        return Cover((max(s - scope, starts[bisect_right(starts, s) - 1]), min(e + scope, stops[bisect_left(stops, e)])) for s, e in spans)

    id_reach, end_reach = reach(ids + strong["access"]), reach(ends)
    secret_reach = reach(secrets + strong["assign"] + strong["hex"])
    return {"weak_id": [s for s in ids if secret_reach.meets(*s)],
            "weak_secret": [s for s in secrets if id_reach.meets(*s) or end_reach.meets(*s)],
            "weak_endpoint": [s for s in ends if secret_reach.meets(*s) and id_reach.meets(*s)]}


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs(doc_id, text)`` -> per row (doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_weak_id, n_weak_secret, n_weak_endpoint).

    Spans are code points of the whole text, end exclusive. A null or empty
    text has none; a null doc_id stays null; repeated rows are scanned each. Parts
    link within ``scope`` code points of one block. A long text of many spans takes time in proportion.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                strong = strong_spans(text or "")
                weak = linked_spans(text or "", strong, scope)
                rows.append((*(len(v) for v in strong.values()), digest(strong), ",".join(in_order(strong | weak)), *(len(v) for v in weak.values())))
            yield {"doc_id": batch.column(0)} | dict(zip(COLUMNS, list(zip(*rows)) or [[]] * len(COLUMNS)))

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), run,
                       "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
                       "n_weak_id bigint, n_weak_secret bigint, n_weak_endpoint bigint")


COLUMNS = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_weak_id", "n_weak_secret", "n_weak_endpoint")
