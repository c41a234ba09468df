"""Geometry text and binary forms.

Well-known text is built from JSON by ordinary expressions. The binary form of whole columns is made in Python a batch at
a time; where few rows have a geometry, `wkb_by_steps` makes it by expressions, as rows that wait for Python are held.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.functions.text import number_text

SRID = 4326

# Geometry kinds, in lower case: text name, binary type code, and nesting letter.
KINDS = {
    "point": ("POINT", 1, "p"),
    "linestring": ("LINESTRING", 2, "l"),
    "polygon": ("POLYGON", 3, "r"),
    "multipoint": ("MULTIPOINT", 4, "l"),
    "multilinestring": ("MULTILINESTRING", 5, "r"),
    "multipolygon": ("MULTIPOLYGON", 6, "m"),
}

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _coordinate_text(text: Column) -> Column:
    return number_text(F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double")))


def _lon_lat(text: Column) -> Column:
    """`"lat,lon"` as `lon lat`, NULL when either is no number."""
    parts = F.transform(F.reverse(F.slice(F.split(text, ",", -1), 1, 2)), _coordinate_text)
    whole = (F.size(parts) == 2) & ~F.exists(parts, lambda p: p.isNull())
    return F.when(whole, F.array_join(parts, " "))


def wkt_from_lat_lon(text: Column, is_polygon: Column) -> Column:
    """Point of a `"lat,lon"` text, or polygon of one ring of a JSON array of such texts.

    The axes are swapped. A ring is not closed for the caller. NULL when any part is no number.
    """
    corners = F.when(is_polygon, F.from_json(text, "array<string>")).otherwise(F.array(text))
    pairs = F.transform(corners, _lon_lat)
    whole = (F.size(corners) > 0) & ~F.exists(pairs, lambda p: p.isNull())
    opening = F.when(is_polygon, "POLYGON ((").otherwise("POINT (")
    closing = F.when(is_polygon, "))").otherwise(")")
    return F.when(whole, F.concat(opening, F.array_join(pairs, ", "), closing))


# A number as JSON writers print it, and a position: two or more of them.
_N = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
_POSITION_2 = rf"\[({_N}),({_N})(?:,{_N})*\]"
_POSITION_3 = rf"\[({_N}),({_N}),({_N})(?:,{_N})*\]"


def _plain_numbers(coordinates: Column) -> Column:
    """Numbers the shortest way: no `.0`, no exponent down to a millionth, and `e` below that."""
    text = F.regexp_replace(coordinates, r"(?<=\d)\.0(?=[E,\]])", "")
    for zeros in (4, 5, 6):
        text = F.regexp_replace(text, rf"(\d)(?:\.(\d+))?E-{zeros}(?!\d)", "0." + "0" * (zeros - 1) + "$1$2")
    return F.regexp_replace(F.replace(text, F.lit("E-"), F.lit("e-")), r"E(?=\d)", "e+")


def wkt_from_geojson(json_text: Column) -> Column:
    """GeoJSON geometry as well-known text, NULL when it is none of the six kinds or is malformed.

    A Feature stands for its geometry and a FeatureCollection of one feature for that feature's. The
    nesting is checked by folding positions into `p`, lists of those into `l`, lists of those into `r`,
    and lists of those into `m`: a kind is well formed when its coordinates fold to its letter.
    """
    collected = F.get_json_object(json_text, "$.features")
    lone = F.when(F.get_json_object(json_text, "$.features[1]").isNull(), F.get_json_object(collected, "$[0].geometry"))
    geometry = F.coalesce(F.get_json_object(json_text, "$.geometry"), lone, json_text)
    folded = F.transform(
        F.array(F.from_json(geometry, "type STRING, coordinates STRING")),
        lambda g: F.struct(F.lower(g["type"]).alias("kind"), _plain_numbers(g["coordinates"]).alias("text")),
    )
    shaped = F.transform(
        folded,
        lambda g: F.struct(
            g["kind"].alias("kind"),
            g["text"].alias("text"),
            g["text"].rlike(rf"^\[*{_N},{_N},{_N}").alias("raised"),
            F.regexp_replace(
                F.regexp_replace(
                    F.regexp_replace(F.regexp_replace(g["text"], _POSITION_2, "p"), r"\[p(,p)*\]", "l"),
                    r"\[l(,l)*\]",
                    "r",
                ),
                r"\[r(,r)*\]",
                "m",
            ).alias("fold"),
        ),
    )
    return F.get(F.transform(shaped, _assembled), 0)


def _assembled(g: Column) -> Column:
    names, letters = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, (name, _, letter) in KINDS.items():
        names = F.when(g["kind"] == kind, name).otherwise(names)
        letters = F.when(g["kind"] == kind, letter).otherwise(letters)
    positions = F.when(g["raised"], F.regexp_replace(g["text"], _POSITION_3, "$1 $2 $3")).otherwise(
        F.regexp_replace(g["text"], _POSITION_2, "$1 $2")
    )
    body = F.translate(F.replace(positions, F.lit(","), F.lit(", ")), "[]", "()")
    body = F.when(g["kind"] == "point", F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
    axis = F.when(g["raised"], " Z ").otherwise(" ")
    return F.when(g["fold"] == letters, F.concat(names, axis, body))


# ---- binary form ------------------------------------------------------------------------------------

# Positions, and what they are nested in, as patterns of the text; all of them match in linear time.
_JSON_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"


def _shapes(width: int) -> dict[str, str]:
    position = rf"\s*{_JSON_NUMBER}" + rf"\s+{_JSON_NUMBER}" * (width - 1) + r"\s*"
    listed = lambda inner: rf"\s*\({inner}(?:,{inner})*\)\s*"
    line = listed(position)
    rings = listed(line)
    # Points of a multipoint stand bare or in parentheses.
    either = rf"(?:{position}|\s*\({position}\)\s*)"
    return {
        "point": rf"\s*\({position}\)\s*",
        "linestring": line,
        "polygon": rings,
        "multipoint": listed(either),
        "multilinestring": rings,
        "multipolygon": listed(rings),
    }


_SHAPES = {2: _shapes(2), 3: _shapes(3)}

# What an opening parenthesis writes, by kind and depth: binary type of a header or 0, and whether a count follows.
_OPENS = {
    "point": {1: (1, False)},
    "linestring": {1: (2, True)},
    "polygon": {1: (3, True), 2: (0, True)},
    "multipoint": {1: (4, True), 2: (0, False)},
    "multilinestring": {1: (5, True), 2: (2, True)},
    "multipolygon": {1: (6, True), 2: (3, True), 3: (0, True)},
}

_HEADER, _COUNT, _DOUBLE = 5, 4, 8


def wkb_of_texts(texts: pa.Array) -> pa.Array:
    """Little-endian well-known binary of well-known texts, null where a text is none.

    All texts of a batch at once: a pattern per kind says which are well formed, what is left is a row of parentheses,
    commas and numbers, and since the binary form has its parts in the order of the text, the place of every header, count
    and coordinate is a running sum.
    """
    texts = texts.cast(pa.large_string())
    result = pa.nulls(len(texts), pa.large_binary())
    named = pc.extract_regex(texts, r"^\s*(?P<kind>[A-Za-z]+)\s*(?P<axis>Z?)\s*(?P<body>\((?s:.*)\))\s*$")
    kinds = pc.utf8_lower(named.field("kind"))
    raised = pc.equal(named.field("axis"), "Z")
    found_at, found = [], []
    for kind in KINDS:
        for width in (2, 3):
            chosen = pc.and_(pc.equal(kinds, kind), pc.equal(raised, width == 3))
            held = pc.and_(chosen, pc.match_substring_regex(named.field("body"), f"^{_SHAPES[width][kind]}$"))
            held = pc.and_(pc.fill_null(held, False), pc.is_valid(texts))
            rows = np.flatnonzero(held.to_numpy(zero_copy_only=False))
            if len(rows):
                found_at.append(rows)
                found.append(_encoded(named.field("body").take(pa.array(rows)), kind, width))
    if not found:
        return result.cast(pa.binary())
    place = np.full(len(texts), -1, np.int64)
    place[np.concatenate(found_at)] = np.arange(sum(map(len, found_at)))
    index = pa.array(place, mask=place < 0)
    return pa.concat_arrays(found).take(index).cast(pa.binary())


def _encoded(bodies: pa.Array, kind: str, width: int) -> pa.Array:
    """Binary form of the bodies of well-formed texts of one kind."""
    ends = np.frombuffer(bodies.buffers()[1], np.int64)[bodies.offset : bodies.offset + len(bodies) + 1]
    chars = np.frombuffer(bodies.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    opened, closed, comma = chars == ord("("), chars == ord(")"), chars == ord(",")
    digits = ~(opened | closed | comma | (chars == 32) | ((chars >= 9) & (chars <= 13)))
    # A number begins where a character of one follows something else, or a text begins.
    before = np.concatenate([[False], digits[:-1]])
    after = np.concatenate([digits[1:], [False]])
    starts, stops = np.flatnonzero(digits & ~before), np.flatnonzero(digits & ~after) + 1
    depth = np.cumsum(opened.astype(np.int64) - closed.astype(np.int64))
    token_at = np.sort(np.concatenate([np.flatnonzero(opened), np.flatnonzero(comma), starts]))
    is_open, is_comma = opened[token_at], comma[token_at]
    is_number = ~is_open & ~is_comma
    level = depth[token_at]
    # A position begins with a number that does not follow another one.
    leads = is_number & ~np.concatenate([[False], is_number[:-1]])
    sizes = np.where(is_number, _DOUBLE, 0)
    if kind == "multipoint":
        sizes = sizes + np.where(leads, _HEADER, 0)
    headers, counts = [], []
    for d, (code, counted) in _OPENS[kind].items():
        at = np.flatnonzero(is_open & (level == d))
        sizes[at] = (_HEADER if code else 0) + (_COUNT if counted else 0)
        if code:
            headers.append((at, code))
        if counted:
            # Elements of a list: the commas directly in it, and one.
            inside = np.searchsorted(at, np.flatnonzero(is_comma & (level == d)), "right") - 1
            counts.append((at, _HEADER if code else 0, np.bincount(inside, minlength=len(at)) + 1))
    offsets = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)

    def put(where: np.ndarray, values: np.ndarray) -> None:
        raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(where), -1)
        out[where[:, None] + np.arange(raw.shape[1])] = raw

    more = 1000 if width == 3 else 0
    if kind == "multipoint":
        headers.append((np.flatnonzero(leads), 1))
    for at, code in headers:
        put(offsets[at], np.ones(len(at), np.uint8))
        put(offsets[at] + 1, np.full(len(at), code + more, "<u4"))
    for at, skip, count in counts:
        put(offsets[at] + skip, count.astype("<u4"))
    at = np.flatnonzero(is_number)
    put(offsets[at] + (np.where(leads[at], _HEADER, 0) if kind == "multipoint" else 0), _numbers(chars, starts, stops))
    # Where the tokens of each text begin.
    first = np.searchsorted(token_at, ends[:-1])
    borders = np.concatenate([offsets, [len(out)]])[np.concatenate([first, [len(token_at)]])]
    return pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(out)])


def _numbers(chars: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Doubles of the numbers that stand between starts and stops."""
    # Numbers and the gaps between them are one array of texts, of which every other one is a number.
    borders = np.stack([starts, stops], axis=1).ravel().astype(np.int64)
    texts = pa.Array.from_buffers(
        pa.large_string(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(chars))]
    )
    return texts.take(pa.array(np.arange(0, len(borders) - 1, 2))).cast(pa.float64()).to_numpy().astype("<f8")


def wkt_to_wkb(wkt: str | None) -> bytes | None:
    """Little-endian well-known binary of one well-known text."""
    return wkb_of_texts(pa.array([wkt], pa.string()))[0].as_py()


@F.arrow_udf(T.BinaryType())
def wkb_from_wkt(wkt: pa.Array) -> pa.Array:
    """Well-known binary of well-known text, NULL where it does not parse."""
    return wkb_of_texts(wkt)


# ---- binary form by expressions ---------------------------------------------------------------------

_SPACE = r"[ \t\n\f\r]"
_NAMED = rf"^{_SPACE}*([A-Za-z]+){_SPACE}*(Z?){_SPACE}*(\([\s\S]*\)){_SPACE}*$"


def wkb_by_steps(wkt: Column) -> Column:
    """What `wkb_from_wkt` gives, without Python; it pays where few rows have a text.

    As in `wkt_from_geojson`, positions are folded into `p`, lists of those into `l` and so on, and a kind is well formed when
    its body folds to its letter. The bytes are put together as hexadecimal text.
    """
    read = F.transform(
        F.array(wkt),
        lambda t: F.struct(
            F.lower(F.regexp_extract(t, _NAMED, 1)).alias("kind"),
            (F.regexp_extract(t, _NAMED, 2) == "Z").alias("raised"),
            F.regexp_replace(
                F.regexp_replace(F.regexp_extract(t, _NAMED, 3), rf"{_SPACE}*([(),]){_SPACE}*", "$1"), rf"{_SPACE}+", " "
            ).alias("body"),
        ),
    )
    positions = {w: rf"(?<=[(,]){_JSON_NUMBER}" + rf" {_JSON_NUMBER}" * (w - 1) + r"(?=[,)])" for w in (2, 3)}
    folded = F.transform(
        read,
        lambda g: F.struct(
            *[g[c].alias(c) for c in ("kind", "raised", "body")],
            F.when(g["raised"], F.regexp_replace(g["body"], positions[3], "p"))
            .otherwise(F.regexp_replace(g["body"], positions[2], "p"))
            .alias("fold"),
        ),
    )
    return F.get(F.transform(folded, lambda g: F.when(_well_formed(g), F.unhex(_hex(g)))), 0)


def _well_formed(g: Column) -> Column:
    fold = F.when(
        g["kind"] == "multipoint",
        # Its points stand bare or in parentheses.
        F.concat(F.lit("("), F.replace(F.substring(g["fold"], F.lit(2), F.length(g["fold"]) - 2), F.lit("(p)"), F.lit("p")), F.lit(")")),
    ).otherwise(g["fold"])
    lines = F.regexp_replace(fold, r"\(p(,p)*\)", "l")
    rings = F.regexp_replace(lines, r"\(l(,l)*\)", "r")
    right = (
        F.when(g["kind"] == "point", fold == "(p)")
        .when(g["kind"].isin("linestring", "multipoint"), lines == "l")
        .when(g["kind"].isin("polygon", "multilinestring"), rings == "r")
        .when(g["kind"] == "multipolygon", F.regexp_replace(rings, r"\(r(,r)*\)", "m") == "m")
    )
    return g["body"].rlike(r"^[-+.0-9eE, ()]+$") & right


def _hex(g: Column) -> Column:
    """Hexadecimal text of the binary form of a well-formed geometry."""
    bare = lambda text: F.regexp_replace(text, r"^\(+|\)+$", "")
    joined = lambda parts: F.array_join(parts, "")
    header = lambda code: F.concat(F.lit("01"), _hex_of_whole(F.when(g["raised"], code + 1000).otherwise(code)))
    position = lambda text: joined(F.transform(F.split(text, " "), _hex_of_double))

    def counted(text: Column, border: str, part) -> Column:
        """The number of the parts of a text and the parts."""
        found = F.transform(F.array(F.split(text, border)), lambda s: F.concat(_hex_of_whole(F.size(s)), joined(F.transform(s, part))))
        return F.get(found, 0)

    line = lambda text: counted(text, ",", position)
    rings = lambda text: counted(text, r"\),\(", line)
    bodies = {
        "point": lambda text: position(text),
        "linestring": line,
        "polygon": rings,
        "multipoint": lambda text: counted(F.translate(text, "()", ""), ",", lambda p: F.concat(header(F.lit(1)), position(p))),
        "multilinestring": lambda text: counted(text, r"\),\(", lambda s: F.concat(header(F.lit(2)), line(s))),
        "multipolygon": lambda text: counted(text, r"\)\),\(\(", lambda s: F.concat(header(F.lit(3)), rings(s))),
    }
    made = F.lit(None).cast("string")
    for kind, (_, code, _) in KINDS.items():
        made = F.when(g["kind"] == kind, F.concat(header(F.lit(code)), bodies[kind](bare(g["body"])))).otherwise(made)
    return made


def _reversed_bytes(text: Column) -> Column:
    return F.regexp_replace(F.reverse(text), "(.)(.)", "$2$1")


def _hex_of_whole(number: Column) -> Column:
    """A whole number below 2^31 in four bytes, the lowest first."""
    return _reversed_bytes(F.lpad(F.hex(number.cast("bigint")), 8, "0"))


def _hex_of_double(text: Column) -> Column:
    """The double of a number's text in eight bytes, the lowest first; infinite where it is beyond the largest.

    Powers of two and what is scaled by them are exact, so the bits come out of plain arithmetic. The estimate of the exponent
    may be one off.
    """
    sized = F.transform(
        F.array(F.abs(text.try_cast("double"))),
        lambda a: F.struct(a.alias("a"), F.greatest(F.coalesce(F.floor(F.log2(a)), F.lit(-1022)), F.lit(-1022)).cast("int").alias("e")),
    )
    two = F.lit(2.0)
    exact = F.transform(
        sized,
        lambda s: F.struct(
            s["a"].alias("a"),
            F.when((F.pow(two, s["e"]) > s["a"]) & (s["e"] > -1022), s["e"] - 1)
            .when(F.pow(two, s["e"] + 1) <= s["a"], s["e"] + 1)
            .otherwise(s["e"])
            .alias("e"),
        ),
    )
    # Below the smallest normal double the exponent stays, and the quotient is less than one.
    bits = F.transform(
        exact,
        lambda s: (s["e"] + 1022).cast("bigint") * F.lit(2**52) + (s["a"] / F.pow(two, s["e"]) * F.lit(2.0**52)).cast("bigint"),
    )
    whole = F.when(F.abs(text.try_cast("double")) < float("inf"), F.get(bits, 0)).otherwise(F.lit(0x7FF << 52))
    signed = F.when(text.startswith("-"), whole + F.lit(-(2**63))).otherwise(whole)
    return _reversed_bytes(F.lpad(F.hex(signed), 16, "0"))


def geometry_struct(wkb: Column) -> Column:
    """The `{wkb, srid}` struct a geometry column holds."""
    return F.when(wkb.isNotNull(), F.struct(wkb.alias("wkb"), F.lit(SRID).alias("srid")))


def canonical_wkb(text: Column) -> Column:
    """Well-known binary of a geometry given as WKT, GeoJSON or hexadecimal WKB text."""
    trimmed = F.trim(text)
    is_hex = trimmed.rlike("^0[01]([0-9A-Fa-f]{2})+$")
    wkt = F.when(trimmed.startswith("{"), wkt_from_geojson(trimmed)).otherwise(trimmed)
    return F.when(is_hex, F.unhex(trimmed)).otherwise(wkb_from_wkt(wkt))
