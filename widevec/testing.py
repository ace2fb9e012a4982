"""A tiny exact model, for checks where no real weights are at hand.

The vector of token ``t`` has ``((t * (2 * d + 1)) mod 64) / 64`` in dimension ``d``. These
are small multiples of 1/64, so float32 sums over them are exact in any order. The model is
written out as an ONNX file, by the public protobuf layout of that format.
"""

import numpy as np

FLOAT, INT32, INT64 = 1, 6, 7


def token_vectors(vocabulary, width):
    tokens = np.arange(vocabulary)[:, None]
    return ((tokens * (2 * np.arange(width) + 1)) % 64 / 64).astype(np.float32)


def check_model(vocabulary=259, width=8, pooled=True, segment_ids=False, ids_type=INT32, copies=1):
    """ONNX bytes. Pooled gives ``embeddings`` (masked mean), else ``last_hidden_state``.

    ``copies`` writes the pooled vector that many times in a row, which makes it as wide as
    a real one at no cost to speak of.
    """
    nodes = [_node("Gather", ["table", "input_ids"], "found")]
    inputs = [("input_ids", ids_type), ("attention_mask", ids_type)]
    hidden = "found"
    if segment_ids:
        inputs.append(("token_type_ids", ids_type))
        nodes += [
            _node("Cast", ["token_type_ids"], "types", to=FLOAT),
            _node("Unsqueeze", ["types", "two"], "types_wide"),
            _node("Add", ["found", "types_wide"], "shifted"),
        ]
        hidden = "shifted"
    if pooled:
        nodes += [
            _node("Cast", ["attention_mask"], "mask", to=FLOAT),
            _node("Unsqueeze", ["mask", "two"], "mask_wide"),
            _node("Mul", [hidden, "mask_wide"], "shown"),
            _node("ReduceSum", ["shown", "one"], "total", keepdims=0),
            _node("ReduceSum", ["mask", "one"], "count", keepdims=1),
            _node("Max", ["count", "least"], "divisor"),
            _node("Div", ["total", "divisor"], "narrow"),
            _node("Tile", ["narrow", "copies"], "embeddings"),
        ]
        output = _value("embeddings", FLOAT, ["sequences", width * copies])
    else:
        # The mask is an input of the graph, so it has to be used.
        nodes += [
            _node("Cast", ["attention_mask"], "mask", to=FLOAT),
            _node("Unsqueeze", ["mask", "two"], "mask_wide"),
            _node("Sub", ["mask_wide", "mask_wide"], "nothing"),
            _node("Add", [hidden, "nothing"], "last_hidden_state"),
        ]
        output = _value("last_hidden_state", FLOAT, ["sequences", "tokens", width])
    constants = [
        _tensor("table", FLOAT, token_vectors(vocabulary, width)),
        _tensor("one", INT64, np.array([1], np.int64)),
        _tensor("two", INT64, np.array([2], np.int64)),
        _tensor("copies", INT64, np.array([1, copies], np.int64)),
        _tensor("least", FLOAT, np.array([1e-9], np.float32)),
    ]
    graph = b"".join(
        [_field(1, node) for node in nodes]
        + [_field(2, b"check")]
        + [_field(5, tensor) for tensor in constants]
        + [_field(11, _value(name, kind, ["sequences", "tokens"])) for name, kind in inputs]
        + [_field(12, output)]
    )
    opset = _field(1, b"") + _number(2, 14)
    return _number(1, 8) + _field(7, graph) + _field(8, opset)


def _varint(value):
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(tag, value):
    return _varint(tag << 3) + _varint(value)


def _field(tag, content):
    return _varint(tag << 3 | 2) + _varint(len(content)) + content


def _node(kind, inputs, output, **attributes):
    out = b"".join(_field(1, name.encode()) for name in inputs)
    out += _field(2, output.encode()) + _field(4, kind.encode())
    for name, value in attributes.items():
        out += _field(5, _field(1, name.encode()) + _number(3, value) + _number(20, 2))
    return out


def _tensor(name, kind, array):
    dims = b"".join(_number(1, size) for size in array.shape)
    return dims + _number(2, kind) + _field(8, name.encode()) + _field(9, array.tobytes())


def _value(name, kind, shape):
    dims = b"".join(
        _field(1, _number(1, size) if isinstance(size, int) else _field(2, size.encode())) for size in shape
    )
    tensor = _number(1, kind) + _field(2, dims)
    return _field(1, name.encode()) + _field(2, _field(1, tensor))
