"""Mixed timestamp formats and zones -> one UTC instant (problem 4).

Method: each value is reduced to a character-class shape mask (every digit becomes ``0``); a mask is
mapped to a field parser once; all values of a mask are then converted together with numpy, local
times through zone transition tables (built from the installed zone database, whose version is kept).

Defined results: null and blank values give no row; a value that names no instant or two (no date, no
such date, a local time skipped or repeated by a clock change) gives ``''``; extra columns are ignored;
empty tables give an empty result; repeated rows give repeated results, keyed by the row's own key.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import filled

# Month names as sites print them, meridiem words, zone abbreviations in hours.
MONTHS = (
    ("jan", "january", "enero", "ene", "januar", "janeiro"),
    ("feb", "february", "febrero", "februar", "fevereiro", "fev"),
    ("mar", "march", "marzo", "märz", "mär", "março"),
    ("apr", "april", "abril", "abr"),
    ("may", "mayo", "mai", "maio"),
    ("jun", "june", "junio", "juni", "junho"),
    ("jul", "july", "julio", "juli", "julho"),
    ("aug", "august", "agosto", "ago"),
    ("sep", "sept", "september", "septiembre", "setembro", "set"),
    ("oct", "october", "octubre", "okt", "oktober", "outubro", "out"),
    ("nov", "november", "noviembre", "novembro"),
    ("dec", "december", "diciembre", "dic", "dez", "dezember", "dezembro"),
)
MONTH_OF = {name: i + 1 for i, names in enumerate(MONTHS) for name in names}
AM = ("am", "a.m.", "오전", "午前", "上午")
PM = ("pm", "p.m.", "오후", "午後", "下午")
ZONE_HOURS = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "kst": 9, "jst": 9, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7,
    "mdt": -6, "pst": -8, "pdt": -7, "bst": 1, "west": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "msk": 3, "brt": -3,
}
AGE_SECONDS = {
    "초": 1, "second": 1, "sec": 1, "秒": 1, "segundo": 1, "sekunde": 1, "分": 60, "분": 60, "minute": 60, "min": 60, "minuto": 60,
    "시간": 3600, "hour": 3600, "hr": 3600, "時間": 3600, "小时": 3600, "hora": 3600, "stunde": 3600,
    "일": 86400, "day": 86400, "日": 86400, "天": 86400, "día": 86400, "dia": 86400, "tag": 86400,
    "주": 604800, "week": 604800, "週間": 604800, "周": 604800, "semana": 604800, "woche": 604800,
}

_ORD = "(?:st|nd|rd|th)?"
_NAME = r"(?P<mon>[^\W\d_]{3,})\.?"
_DATES = tuple(
    (kind, re.compile(p))
    for kind, p in (
        ("ymd", r"(?P<y>0000)(?P<s>[-./])(?P<m>00?)(?P=s)(?P<d>00?)\.?"),
        ("ymd", r"(?P<y>0000)\. ?(?P<m>00?)\. ?(?P<d>00?)\.?"),
        ("ymd", r"(?P<y>0000) ?[년年] ?(?P<m>00?) ?[월月] ?(?P<d>00?) ?[일日号]"),
        ("ymd", r"(?P<y>0000)(?P<m>00)(?P<d>00)(?!0)"),
        ("named", rf"{_NAME} (?P<d>00?){_ORD},? (?P<y>0000)"),
        ("named", rf"(?P<d>00?){_ORD}\.? (?:de )?{_NAME},? (?:de )?(?P<y>0000)"),
        ("named", rf"(?P<d>00?)-{_NAME}-(?P<y>0000)"),
        ("order3", r"(?P<a>00?)(?P<s>[-./])(?P<b>00?)(?P=s)(?P<c>0000|00)(?!0)"),
        ("order3", r"(?P<a>00?)\. (?P<b>00?)\. (?P<c>0000|00)\.?(?!0)"),
        ("md", r"(?P<m>00?) ?[월月] ?(?P<d>00?) ?[일日号]"),
        ("named2", rf"{_NAME} (?P<d>00?){_ORD}"),
        ("named2", rf"(?P<d>00?){_ORD}\.? (?:de )?{_NAME}"),
        ("order2", r"(?P<a>00?)(?P<s>[-./])(?P<b>00?)(?![-./0])"),
    )
)
_MERIDIEM = "|".join(re.escape(x) for x in AM + PM)
_TIME = re.compile(
    rf"(?:(?P<ap1>{_MERIDIEM}) ?)?(?P<H>00?)(?: ?[시時点] ?(?:(?P<M1>00?) ?[분分](?: ?(?P<S1>00?) ?[초秒])?)?"
    rf"|:(?P<M2>00)(?::(?P<S2>00)(?:[.,]0+)?)?)(?: ?(?P<ap2>{_MERIDIEM})(?![a-z]))?",
    re.I,
)
_COMPACT_TIME = re.compile(r"(?P<H>00)(?P<M2>00)(?P<S2>00)?(?:[.,]0+)?(?!0)")
_ZONE = re.compile(
    r" ?(?:(?P<abbr>[a-z]{1,5})|\(?(?:(?:gmt|utc) ?)?(?P<sign>[+-])(?P<oh>00?):?(?P<om>00)?\)?|\((?P<abbr2>[a-z]{1,5})\))"
    r"(?: ?\([a-z ]+\)| ?\[[a-z_/+-]+\])?$",
    re.I,
)
_WEEKDAY = re.compile(r"(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,? ", re.I)
_WEEKDAY_CJK = re.compile(r" ?\([월화수목금토일月火水木金土日]\)")
_DIGIT = {ord(c): "0" for c in "123456789"}
_AGE = re.compile(r"(?:vor |hace |há )?(?P<n>0+|an?|un[ao]?|eine?[rn]?) ?(?P<u>[^\W\d_]+?)(?:s|es|n|en)?(?: ago| 전| ?前|前| atrás)?\.?$", re.I)
_AGE_MARK = re.compile(r"ago|전$|前$|^vor |^hace |^há |atrás$", re.I)


class Plan:
    """How to read all values of one mask: the span of each field, constants, and what is missing."""

    __slots__ = ("ap", "const", "kind", "offset", "span")

    def __init__(self, kind: str, span: dict[str, tuple[int, int]], const: dict[str, int], ap: int, offset: tuple | None):
        self.kind, self.span, self.const, self.ap, self.offset = kind, span, const, ap, offset


@lru_cache(maxsize=65536)
def plan_for(mask: str, ages: bool) -> Plan | None:
    """The parser of a mask, or None when it names no instant. ``ages``: relative and partial forms are read."""
    n = len(mask)
    if set(mask) == {"0"} and n != 8:
        if n == 14:
            return Plan("ymd", {"y": (0, 4), "m": (4, 6), "d": (6, 8), "H": (8, 10), "M": (10, 12), "S": (12, 14)}, {}, 0, None)
        return Plan("epoch", {"e": (0, n)}, {"div": 1 if n <= 11 else 1000 if n <= 14 else 1_000_000}, 0, (0, 0, 1)) if 9 <= n <= 16 else None
    if ages and _AGE_MARK.search(mask) and (m := _AGE.fullmatch(mask)):
        unit = AGE_SECONDS.get(m["u"].lower())
        if unit:
            return Plan("age", {"n": m.span("n")} if m["n"][0] == "0" else {}, {"unit": unit}, 0, None)
        return None
    pos = m.end() if (m := _WEEKDAY.match(mask)) else 0
    lead = mask[pos:]
    for kind, pattern in _DATES:
        m = pattern.match(mask, pos)
        if not m:
            continue
        g = {k: v for k, v in m.groupdict().items() if v is not None}
        const = {}
        if "mon" in g:
            month = MONTH_OF.get(g["mon"].lower())
            if month is None:
                continue
            const["m"] = month
        if kind in ("order2", "named2", "md") and not ages:
            return None
        span = {k: m.span(k) for k in g if k not in ("s", "mon")}
        at = m.end()
        if w := _WEEKDAY_CJK.match(mask, at):
            at = w.end()
        rest = mask[at:]
        skip = re.match(r"[T,]? ?(?:at |um |a las |, )?", rest, re.I).end() if rest[:1] in ("T", "t", ",", " ") else 0
        tail = at + skip
        t = _TIME.match(mask, tail) or (_COMPACT_TIME.match(mask, tail) if skip else None)
        ap = 0
        if t:
            tg = {k: v for k, v in t.groupdict().items() if v is not None}
            word = (tg.get("ap1") or tg.get("ap2") or "").lower()
            ap = 1 if word in AM else 2 if word in PM else 0
            for k in ("H", "M1", "M2", "S1", "S2"):
                if k in tg:
                    span[k[0]] = t.span(k)
            at = t.end()
            if mask[at:at + 1] == " " and mask[at:].strip() in ("uhr", "Uhr", "h"):
                at = n
        zone = _zone(mask, at)
        if zone is False:
            continue
        return Plan(kind, span, const, ap, zone)
    t = _TIME.fullmatch(lead) or next((x for x in [_TIME.match(lead)] if x and _zone(lead, x.end()) not in (False, None)), None)
    if t and ages and (t["M1"] or t["M2"]):
        span = {k[0]: (t.start(k) + pos, t.end(k) + pos) for k in ("H", "M1", "M2", "S1", "S2") if t[k] is not None}
        word = (t["ap1"] or t["ap2"] or "").lower()
        return Plan("time", span, {}, 1 if word in AM else 2 if word in PM else 0, _zone(lead, t.end()))
    return None


def _zone(mask: str, at: int):
    """None: no zone is named; False: what follows isn't a zone; else (start of sign, spans) or fixed seconds."""
    if not mask[at:].strip():
        return None
    m = _ZONE.match(mask, at)
    if not m:
        if re.fullmatch(r" ?\[[A-Za-z_]+/[A-Za-z_/]+\]", mask[at:]):
            return ("region", mask[at:].strip(" []"), None)
        return False
    if m["abbr"] or m["abbr2"]:
        hours = ZONE_HOURS.get((m["abbr"] or m["abbr2"]).lower())
        return False if hours is None else ("fixed", hours * 3600, None)
    return ("signed", -1 if m["sign"] == "-" else 1, (m.span("oh"), m.span("om") if m["om"] else None))


FIRST = -2_208_988_800  # 1900


@lru_cache(maxsize=1024)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """UTC seconds at which the offset changes and the offsets from then on, 1900 to 2099 (before it: the first one known); None for an unknown zone."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    try:
        z = ZoneInfo(zone)
    except Exception:  # noqa: BLE001 - unknown or malformed zone names mean "no zone"
        return None
    off = lambda s: int(datetime.fromtimestamp(s, timezone.utc).astimezone(z).utcoffset() / timedelta(seconds=1))
    step, last, times, offsets = 86400 * 5, off(FIRST), [-(2**62)], [off(FIRST)]
    for s in range(FIRST + step, 4_102_444_800, step):
        now = off(s)
        if now != last:
            lo, hi = s - step, s
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if off(mid) == last else (lo, mid)
            times.append(hi)
            offsets.append(now)
            last = now
    return np.array(times, dtype=np.int64), np.array(offsets, dtype=np.int64)


def zone_database_version() -> str:
    """The version of the zone database that the tables come from: its package's, else that of the system's files, else a fingerprint of some tables."""
    import hashlib
    import importlib.metadata
    import zoneinfo
    from pathlib import Path

    for folder in zoneinfo.TZPATH:  # zoneinfo reads these before the package
        for name in ("tzdata.zi", "+VERSION"):
            f = Path(folder) / name
            if f.exists():
                return "system " + f.read_text(errors="replace").splitlines()[0].lstrip("# version")
        if Path(folder).is_dir():
            parts = [transitions(z) for z in ("Europe/Berlin", "America/New_York", "America/Sao_Paulo", "Asia/Seoul")]
            return "system " + hashlib.sha1(b"".join(a.tobytes() for p in parts if p for a in p)).hexdigest()[:12]
    try:
        return "tzdata " + importlib.metadata.version("tzdata")
    except importlib.metadata.PackageNotFoundError:
        return "none"


def local_to_utc(local: np.ndarray, zone: str) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds of local seconds, and how many instants each names (0: skipped, 1, 2: repeated)."""
    table = transitions(zone)
    if table is None:
        return local, np.zeros(len(local), dtype=np.int64)
    times, offsets = table
    i = np.searchsorted(times, local - 86400, side="right") - 1
    found, n = np.zeros_like(local), np.zeros(len(local), dtype=np.int64)
    for k in range(3):  # the offsets in force within a day of it
        j = np.minimum(i + k, len(times) - 1)
        utc = local - offsets[j]
        ok = (np.searchsorted(times, utc, side="right") - 1 == j) & ((k == 0) | (j == i + k))
        found = np.where(ok & (n == 0), utc, found)
        n += ok
    return found, n


_DAYS = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])


def _epoch_days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 and whether the date exists."""
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    mm = np.clip(m, 1, 12)
    ok = (m >= 1) & (m <= 12) & (d >= 1) & (d <= _DAYS[mm] + (leap & (mm == 2))) & (y >= 1000)
    months = (np.where(ok, y, 1970) - 1970) * 12 + mm - 1
    return months.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) + np.where(ok, d, 1) - 1, ok


def convert(values: list[str], plan: Plan, zone: str, order: str, fetched: np.ndarray, partial: bool) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds and validity of values that share a mask, a home zone and a date order."""
    n = len(values)
    width = len(values[0])
    digits = np.array(values, dtype=f"U{width}").view(np.uint32).reshape(n, width).astype(np.int64) - 48

    def num(k: str, default: int = 0) -> np.ndarray:
        if k in plan.const:
            return np.full(n, plan.const[k], dtype=np.int64)
        if k not in plan.span:
            return np.full(n, default, dtype=np.int64)
        a, b = plan.span[k]
        out = np.zeros(n, dtype=np.int64)
        for i in range(a, b):
            out = out * 10 + digits[:, i]
        return out

    if plan.kind == "epoch":
        s = num("e") // plan.const["div"]
        return s, s < 4_102_444_800
    has_fetch = fetched > -(2**61)
    if plan.kind == "age":
        return fetched - num("n", 1) * plan.const["unit"], has_fetch
    H, M, S = num("H"), num("M"), num("S")
    ok = (H <= 23) & (M <= 59) & (S <= 59)
    if plan.ap:
        ok &= H <= 12
        H = np.where(H == 12, 0, H) + (12 if plan.ap == 2 else 0)
    secs = H * 3600 + M * 60 + S

    def instant(days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        local = days * 86400 + secs
        if plan.offset is None:
            return local_to_utc(local, zone)
        kind, x, spans = plan.offset
        if kind == "region":
            return local_to_utc(local, x)
        if kind == "fixed":
            return local - x, np.ones(n, dtype=np.int64)
        (a, b), om = spans
        off = sum(digits[:, i] * 10 ** (b - 1 - i) for i in range(a, b)) * 3600
        if om:
            off = off + (digits[:, om[0]] * 10 + digits[:, om[0] + 1]) * 60
        return local - x * off, (off <= 18 * 3600).astype(np.int64)

    if plan.kind == "time":
        base = fetched // 86400
        best, how = np.full(n, -(2**62), dtype=np.int64), np.zeros(n, dtype=np.int64)
        for back in (1, 0, -1, -2, -3):
            utc, count = instant(base + back)
            use = (how == 0) & (count > 0) & (utc <= fetched)
            best, how = np.where(use, utc, best), np.where(use, count, how)
        return best, ok & (how == 1) & has_fetch
    if plan.kind in ("ymd", "named"):
        y, m, d = num("y"), num("m"), num("d")
    elif plan.kind == "order3":
        a, b, c = num("a"), num("b"), num("c")
        year_last = plan.span["c"][1] - plan.span["c"][0] == 4
        if order == "dmy" or (order == "ymd" and year_last):
            d, m, y = a, b, c
        elif order == "mdy":
            m, d, y = a, b, c
        else:
            y, m, d = a, b, c
        y = np.where(y < 100, np.where(y < 70, 2000, 1900) + y, y)
    else:
        if plan.kind == "order2":
            a, b = num("a"), num("b")
            m, d = (b, a) if order == "dmy" else (a, b)
        else:
            m, d = num("m"), num("d")
        year = 1970 + np.where(has_fetch, fetched, 0).astype("datetime64[s]").astype("datetime64[Y]").astype(np.int64)
        best, how = np.full(n, -(2**62), dtype=np.int64), np.zeros(n, dtype=np.int64)
        for back in range(-1, 9):
            days, exists = _epoch_days(year - back, m, d)
            utc, count = instant(days)
            use = exists & (how == 0) & (count > 0) & (utc <= fetched)
            best, how = np.where(use, utc, best), np.where(use, count, how)
        return best, ok & (how == 1) & has_fetch
    days, exists = _epoch_days(y, m, d)
    utc, count = instant(days)
    return utc, ok & exists & (count == 1)


def clean(value: str) -> str:
    """NFKC, single blanks, no blanks around."""
    if not value.isascii():
        value = unicodedata.normalize("NFKC", value).replace("​", "").replace("−", "-")
    return " ".join(value.split())


def normalise_batch(values: pd.Series, zones: pd.Series, orders: pd.Series, fetched: pd.Series, partial: bool) -> np.ndarray:
    """The instants of one batch as strings; ``''`` where a value names not exactly one."""
    out = np.full(len(values), "", dtype=object)
    cleaned = [clean(v) for v in values]
    stamps = fetched.to_numpy(dtype="datetime64[s]").astype(np.int64)
    groups: dict[tuple, list[int]] = {}
    zl, ol = zones.fillna("").tolist(), orders.fillna("ymd").tolist()
    for i, v in enumerate(cleaned):
        groups.setdefault((v.translate(_DIGIT), zl[i], ol[i]), []).append(i)
    for (mask, zone, order), rows in groups.items():
        plan = plan_for(mask, partial)
        if plan is None:
            continue
        at = np.array(rows)
        utc, ok = convert([cleaned[i] for i in rows], plan, zone, order, stamps[at], partial)
        good = at[ok]
        out[good] = [str(x) + "Z" for x in utc[ok].astype("datetime64[s]")]
    return out


def is_settled(value: Column) -> Column:
    """Whether a value is already a valid ``YYYY-MM-DDTHH:MM:SSZ``."""
    return value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$") & F.try_to_timestamp(value).isNotNull()


def normalise(values: DataFrame, source_info: DataFrame) -> DataFrame:
    """(tbl, row_key, field, source, value, fetched_at, partial) -> (tbl, row_key, field, instant_utc), one row for each value to settle.

    ``partial``: missing years or days and ages are read against fetched_at. Sources that source_info
    doesn't have get no home zone, so that their zoneless values are ''.
    """
    todo = values.select("tbl", "row_key", "field", "source", "value", "fetched_at", "partial").filter(F.col("value").rlike(r"[^\s\p{Z}\x{FEFF}\x{200B}]") & ~F.coalesce(is_settled(F.col("value")), F.lit(False)))
    info = source_info.select("source", "home_zone", "date_order").dropDuplicates(["source"])
    joined = todo.join(info, "source", "left").select("tbl", "row_key", "field", "value", "home_zone", "date_order", "partial", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.reset_index(drop=True)
            out = np.full(len(b), "", dtype=object)
            for flag in (True, False):
                at = np.flatnonzero(b["partial"].to_numpy(dtype=bool) == flag)
                if len(at):
                    x = b.iloc[at]
                    out[at] = normalise_batch(x["value"], x["home_zone"], x["date_order"], x["fetched_at"], flag)
            yield from filled(pd.DataFrame({"tbl": b["tbl"], "row_key": b["row_key"], "field": b["field"], "instant_utc": out}))

    return joined.mapInPandas(run, "tbl string, row_key long, field string, instant_utc string")


def stack_values(unified: DataFrame, comments: DataFrame) -> DataFrame:
    """All timestamp strings of both tables in one long form, each table read once."""
    u = unified.select(
        F.lit("unified_rows").alias("tbl"), F.col("row_id").alias("row_key"), "source", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        F.explode(F.array(
            F.struct(F.lit("published_at").alias("field"), F.col("published_at").alias("value")),
            F.struct(F.lit("comment_publishedAt").alias("field"), F.col("comment_publishedAt").alias("value")),
        )).alias("v"),
    ).select("tbl", "row_key", "source", "fetched_at", "v.field", "v.value", F.lit(False).alias("partial"))
    c = comments.select(
        F.lit("raw_comments").alias("tbl"), F.col("comment_key").alias("row_key"), "source", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        F.lit("published_at_raw").alias("field"), F.col("published_at_raw").alias("value"), F.lit(True).alias("partial"),
    )
    return u.unionByName(c)
