"""Vector tiles in the public protobuf format (version 2): polygons with one string attribute, `kind`, are written; any tile is read and merged."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from .geometry import Point, area

# Field numbers and commands of the format.
TILE_LAYER = 3
LAYER_NAME, LAYER_FEATURE, LAYER_KEY, LAYER_VALUE, LAYER_EXTENT, LAYER_VERSION = 1, 2, 3, 4, 5, 15
FEATURE_TAGS, FEATURE_TYPE, FEATURE_GEOMETRY = 2, 3, 4
VALUE_STRING = 1
DEFAULT_EXTENT = 4096
POLYGON, MOVE, LINE, CLOSE = 3, 1, 2, 7


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def number_field(field: int, n: int) -> bytes:
    return varint(field << 3) + varint(n)


def bytes_field(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def packed(field: int, numbers: Iterable[int]) -> bytes:
    return bytes_field(field, b"".join(map(varint, numbers)))


def zigzag(n: int) -> int:
    return n << 1 if n >= 0 else -n * 2 - 1


def commands(polygons: list[list[list[Point]]]) -> list[int]:
    """Drawing commands: outer rings turn one way (positive area, y downward), holes the other; steps are relative."""
    out, x, y = [], 0, 0
    for rings in polygons:
        for i, ring in enumerate(rings):
            if (area(ring) > 0) != (i == 0):
                ring = ring[::-1]
            for n, (px, py) in enumerate(ring):
                if n < 2:
                    out.append(MOVE | 1 << 3 if n == 0 else LINE | (len(ring) - 1) << 3)
                out += [zigzag(int(px) - x), zigzag(int(py) - y)]
                x, y = int(px), int(py)
            out.append(CLOSE | 1 << 3)
    return out


def encode(features: list[tuple[str, str, list[list[list[Point]]]]], extent: int) -> bytes:
    """A tile of (layer, kind, polygons); layers and kinds in order of name."""
    out = bytearray()
    for name in sorted({f[0] for f in features}):
        mine = [(kind, polygons) for layer, kind, polygons in features if layer == name]
        kinds = sorted({kind for kind, _ in mine})
        body = layer_head(name)
        for kind, polygons in mine:
            body += feature_field(kinds.index(kind), polygons)
        out += layer_field(body, kinds, extent)
    return bytes(out)


def layer_head(name: str) -> bytearray:
    return bytearray(number_field(LAYER_VERSION, 2) + bytes_field(LAYER_NAME, name.encode()))


def feature_field(kind: int, polygons: list[list[list[Point]]]) -> bytes:
    return bytes_field(LAYER_FEATURE, packed(FEATURE_TAGS, (0, kind)) + number_field(FEATURE_TYPE, POLYGON) + packed(FEATURE_GEOMETRY, commands(polygons)))


def layer_field(body: bytearray, kinds: list[str], extent: int) -> bytearray:
    """A layer of a tile: what stands before its features and they themselves, then its kinds and extent."""
    body += bytes_field(LAYER_KEY, b"kind") + b"".join(bytes_field(LAYER_VALUE, bytes_field(VALUE_STRING, k.encode())) for k in kinds) + number_field(LAYER_EXTENT, extent)
    return bytearray(varint(TILE_LAYER << 3 | 2) + varint(len(body))) + body


def encode_sorted(features: Iterable[tuple[str, str, list[list[list[Point]]]]], extent: int) -> bytearray:
    """The same of features in order of layer and kind, which pass by one at a time: only what is written is held."""
    out, last, body, kinds = bytearray(), None, bytearray(), []
    for layer, kind, polygons in features:
        if last is not None and (layer, kind) < last:
            raise ValueError("features out of order")
        if last is None or layer != last[0]:
            if last is not None:
                out += layer_field(body, kinds, extent)
            body, kinds = layer_head(layer), []
        if not kinds or kind != kinds[-1]:
            kinds.append(kind)
        last = layer, kind
        body += feature_field(len(kinds) - 1, polygons)
    return out + layer_field(body, kinds, extent) if last is not None else out


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    """A number and where it ends."""
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def read_fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(field, value, the field as it stands) of a message; values of fixed width are bytes."""
    at = 0
    while at < len(data):
        begin = at
        key, at = read_varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = read_varint(data, at)
        elif kind == 2:
            size, at = read_varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError("not a vector tile")
        if at > len(data):
            raise ValueError("the tile is cut short")
        yield key >> 3, value, data[begin:at]


def read_packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        n, at = read_varint(data, at)
        out.append(n)
    return out


def unzigzag(n: int) -> int:
    return n >> 1 if n & 1 == 0 else -((n + 1) >> 1)


@dataclass
class Layer:
    """A layer as it stands: features are messages, values are messages; only what a merge must look into is read."""

    name: bytes
    version: int = 1
    extent: int = DEFAULT_EXTENT
    keys: list[bytes] = field(default_factory=list)
    values: list[bytes] = field(default_factory=list)
    features: list[bytes] = field(default_factory=list)
    others: list[bytes] = field(default_factory=list)

    def message(self) -> bytes:
        out = bytearray(number_field(LAYER_VERSION, self.version) + bytes_field(LAYER_NAME, self.name))
        for number, held in ((LAYER_FEATURE, self.features), (LAYER_KEY, self.keys), (LAYER_VALUE, self.values)):
            for message in held:
                out += bytes_field(number, message)
        out += number_field(LAYER_EXTENT, self.extent)
        for raw in self.others:
            out += raw
        return bytes(out)


def layers_of(tile: bytes) -> list[Layer]:
    out = []
    for number, body, _ in read_fields(tile):
        if number == TILE_LAYER:
            layer = Layer(b"")
            for f, value, raw in read_fields(body):
                if f == LAYER_NAME:
                    layer.name = value
                elif f == LAYER_VERSION:
                    layer.version = value
                elif f == LAYER_EXTENT:
                    layer.extent = value
                elif f in (LAYER_KEY, LAYER_VALUE, LAYER_FEATURE):
                    {LAYER_KEY: layer.keys, LAYER_VALUE: layer.values, LAYER_FEATURE: layer.features}[f].append(value)
                else:
                    layer.others.append(raw)
            out.append(layer)
    return out


def scaled(numbers: list[int], factor: float) -> list[int]:
    """Drawing commands in other units: each point is rounded by itself, so points that were one stay one."""
    out, at, x, y, u, v = [], 0, 0, 0, 0, 0
    while at < len(numbers):
        command = numbers[at]
        out.append(command)
        at += 1
        for _ in range(command >> 3 if command & 7 != CLOSE else 0):
            x, y = x + unzigzag(numbers[at]), y + unzigzag(numbers[at + 1])
            at += 2
            p, q = round(x * factor), round(y * factor)
            out += [zigzag(p - u), zigzag(q - v)]
            u, v = p, q
    return out


def add_layer(to: Layer, more: Layer) -> None:
    """All features of a layer of the same name, with their attributes' keys and values numbered anew and their geometry in the first one's
    units."""
    keys, values = ({x: i for i, x in reversed(list(enumerate(held)))} for held in (to.keys, to.values))
    number = lambda known, held, x: known[x] if x in known else known.setdefault(x, held.append(x) or len(held) - 1)
    key_of = [number(keys, to.keys, k) for k in more.keys]
    value_of = [number(values, to.values, v) for v in more.values]
    for feature in more.features:
        body = b""
        for f, value, raw in read_fields(feature):
            if f == FEATURE_TAGS:
                tags = read_packed(value)
                raw = packed(FEATURE_TAGS, [(value_of if i % 2 else key_of)[t] for i, t in enumerate(tags)])
            elif f == FEATURE_GEOMETRY and more.extent != to.extent:
                raw = packed(FEATURE_GEOMETRY, scaled(read_packed(value), to.extent / more.extent))
            body += raw
        to.features.append(body)
    to.version = max(to.version, more.version)


def merged(tiles: Iterable[bytes]) -> bytes:
    """One tile with all features of several: each layer name once, in order of first appearance."""
    layers: dict[bytes, Layer] = {}
    for tile in tiles:
        for layer in layers_of(tile):
            if layer.name in layers:
                add_layer(layers[layer.name], layer)
            else:
                layers[layer.name] = layer
    return b"".join(bytes_field(TILE_LAYER, layer.message()) for layer in layers.values())


def rings_of(numbers: list[int]) -> list[list[Point]]:
    """The rings that drawing commands draw."""
    out: list[list[Point]] = []
    at, x, y = 0, 0, 0
    while at < len(numbers):
        command, at = numbers[at], at + 1
        if command & 7 == MOVE:
            out.append([])
        for _ in range(command >> 3 if command & 7 != CLOSE else 0):
            x, y, at = x + unzigzag(numbers[at]), y + unzigzag(numbers[at + 1]), at + 2
            out[-1].append((float(x), float(y)))
    return out


def decode(tile: bytes) -> Iterator[tuple[int, str, dict[str, str], int, list[list[Point]], int]]:
    """(layer's place, layer, attributes, geometry type, rings, extent) of each feature. Attributes that aren't text are given as their messages."""
    for nth, layer in enumerate(layers_of(tile)):
        for feature in layer.features:
            found = {f: value for f, value, _ in read_fields(feature)}
            tags = read_packed(found.get(FEATURE_TAGS, b""))
            said = {}
            for k, v in zip(tags[::2], tags[1::2], strict=True):
                message = dict((f, x) for f, x, _ in read_fields(layer.values[v]))
                said[layer.keys[k].decode()] = message[VALUE_STRING].decode() if VALUE_STRING in message else repr(message)
            yield nth, layer.name.decode(), said, found.get(FEATURE_TYPE, 0), rings_of(read_packed(found.get(FEATURE_GEOMETRY, b""))), layer.extent
