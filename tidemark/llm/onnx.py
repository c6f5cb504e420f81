"""A bidirectional LSTM with a projection as an ONNX graph, run by onnxruntime in the calling thread."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

try:
    import onnxruntime
except ImportError:  # numpy computes the same
    onnxruntime = None

_FLOAT, _INT64 = 1, 7


# ONNX files are protobuf messages; the package that writes them is not needed for the few fields used here.


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _fields(number: int, values: list) -> bytes:
    return b"".join(_field(number, v) for v in values)


def _attribute(name: str, value: int | list[int] | bytes) -> bytes:
    """An integer, integers or a graph."""
    if isinstance(value, int):
        return _field(1, name) + _field(3, value) + _field(20, 2)
    if isinstance(value, bytes):
        return _field(1, name) + _field(6, value) + _field(20, 5)
    return _field(1, name) + _fields(8, value) + _field(20, 7)


def _node(op: str, given: str, made: str, **attributes: int | list[int] | bytes) -> bytes:
    return _fields(1, given.split()) + _fields(2, made.split()) + _field(4, op) + _fields(5, [_attribute(k, v) for k, v in attributes.items()])


def _tensor(name: str, a: np.ndarray) -> bytes:
    return _fields(1, list(a.shape)) + _field(2, _FLOAT) + _field(8, name) + _field(9, np.ascontiguousarray(a, np.float32).tobytes())


def _value(name: str, kind: int, *shape: int | str) -> bytes:
    dims = [_field(1, d) if isinstance(d, int) else _field(2, d) for d in shape]
    return _field(1, name) + _field(2, _field(1, _field(1, kind) + _field(2, _fields(1, dims))))


def lstm_graph(p: dict[str, np.ndarray]) -> bytes:
    """The model that gives emissions (window, place, label) of classes `x` (place, window) with the weights of a Tagger.

    One scan reads the places in both directions and gives back each direction's part of the emissions. What a class
    adds to the gates is looked up, as embedding, input weights and bias make one row for each class.
    """
    width, labels = p["U"].shape[1], len(p["c"])
    weights, step = {"c": p["c"]}, []
    for k, d in (("f", 0), ("b", 1)):
        weights |= {f"given_{k}": p["E"] @ p["W"][d] + p["b"][d], f"U_{k}": p["U"][d], f"P_{k}": p["P"][d * width : (d + 1) * width]}
        step += [
            _node("Gather", f"given_{k} x_{k}", f"in_{k}", axis=0),
            _node("Gemm", f"h_{k} U_{k} in_{k}", f"z_{k}"),
            _node("Split", f"z_{k}", f"zi_{k} zf_{k} zg_{k} zo_{k}", axis=1, num_outputs=4),
            *(_node("Sigmoid", f"z{gate}_{k}", f"{gate}_{k}") for gate in "ifo"),
            _node("Tanh", f"zg_{k}", f"g_{k}"),
            _node("Mul", f"f_{k} c_{k}", f"held_{k}"),
            _node("Mul", f"i_{k} g_{k}", f"new_{k}"),
            _node("Add", f"held_{k} new_{k}", f"next_c_{k}"),
            _node("Tanh", f"next_c_{k}", f"tc_{k}"),
            _node("Mul", f"o_{k} tc_{k}", f"next_h_{k}"),
            _node("Gemm", f"next_h_{k} P_{k}" + " c" * (k == "f"), f"e_{k}"),
        ]
    states = [f"{s}_{k}" for k in "fb" for s in "hc"]
    body = _fields(1, step) + _field(2, "step")
    body += _fields(11, [*(_value(s, _FLOAT, "n", width) for s in states), *(_value(f"x_{k}", _INT64, "n") for k in "fb")])
    body += _fields(12, [*(_value(f"next_{s}", _FLOAT, "n", width) for s in states), *(_value(f"e_{k}", _FLOAT, "n", labels) for k in "fb")])
    scan = _node(
        "Scan", "zero zero zero zero x x", "last_h_f last_c_f last_h_b last_c_b forth back",
        body=body, num_scan_inputs=2, scan_input_directions=[0, 1], scan_output_directions=[0, 1],
    )
    graph = _fields(1, [scan, _node("Add", "forth back", "both"), _node("Transpose", "both", "e", perm=[1, 0, 2])]) + _field(2, "tagger") + _fields(5, [_tensor(k, a) for k, a in weights.items()])
    graph += _fields(11, [_value("x", _INT64, "steps", "n"), _value("zero", _FLOAT, "n", width)]) + _field(12, _value("e", _FLOAT, "n", "steps", labels))
    return _field(1, 8) + _field(8, _field(1, "") + _field(2, 18)) + _field(7, graph)


def lstm_emissions(p: dict[str, np.ndarray]) -> Callable[[np.ndarray], np.ndarray] | None:
    """A function from windows (window, place) to emissions (window, place, label); None without onnxruntime."""
    if onnxruntime is None:
        return None
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1
    session = onnxruntime.InferenceSession(lstm_graph(p), options, providers=["CPUExecutionProvider"])
    width = p["U"].shape[1]

    def run(x: np.ndarray) -> np.ndarray:
        return session.run(None, {"x": np.ascontiguousarray(x.T, np.int64), "zero": np.zeros((len(x), width), np.float32)})[0]

    return run
