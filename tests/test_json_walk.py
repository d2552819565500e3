import json
import random

import pytest
from rate_docs import INLINE_DOC, REFERENCE_DOC, write_json

from ratescape.sources import json_walk


@pytest.mark.parametrize("window", [1, 2, 3, 7, 64])
def test_any_window_gives_the_same_pieces(tmp_path, monkeypatch, window):
    doc = {**REFERENCE_DOC, "count": 123456, "note": "näïve ✓ \" \\ ] } text \\\\", "other": [{"in_network": [{}]}, "[{"], "last": 1.5e3}
    path = write_json(tmp_path / "a.json", json.dumps(doc, ensure_ascii=False, indent=1))
    whole = list(json_walk.walk_rate_file(path, ".*"))
    monkeypatch.setattr(json_walk, "BLOCK_BYTES", window)
    assert list(json_walk.walk_rate_file(path, ".*")) == whole
    header = json.loads(whole[-1][-1])
    assert header["count"] == 123456 and header["last"] == 1500.0 and header["note"].startswith("näïve")


def test_rates_of_other_codes_are_left_out(tmp_path):
    path = write_json(tmp_path / "a.json.gz", INLINE_DOC)
    kinds = [p[0] for p in json_walk.walk_rate_file(path, "9999.")]
    assert kinds == ["item", "item", "header"]
    kinds = [p[0] for p in json_walk.walk_rate_file(path, "97155")]
    assert kinds == ["rate", "item", "item", "header"]


def test_window_of_a_block_with_many_escapes(tmp_path, monkeypatch):
    rng = random.Random(5)
    items = []
    for n in range(40):
        text = "".join(rng.choice('\\"[]{},: aé\n') for _ in range(rng.randint(0, 30)))
        rate = {"provider_groups": [], "note": text, "negotiated_prices": [{"x": text}]}
        items.append({"name": text, "billing_code": str(n), text + "k": [text], "negotiated_rates": [rate, None, rate]})
    path = write_json(tmp_path / "a.json", {"pre": '\\"', "in_network": items})
    for window in (1, 5, 17, 1000, 1 << 20):
        monkeypatch.setattr(json_walk, "BLOCK_BYTES", window)
        pieces = list(json_walk.walk_rate_file(path, ".*"))
        rates = [(p[1], json.loads(p[4])) for p in pieces if p[0] == "rate"]
        assert rates == [(n, r) for n, i in enumerate(items) for r in i["negotiated_rates"] if r]
        names = [json.loads(p[4])["name"] for p in pieces if p[0] == "item"]
        assert names == [i["name"] for i in items]


@pytest.mark.parametrize("text", ["", "null", "[]", '{"in_network": [', '{"a" 1}', '{"a": 12', '{"a": "x'])
def test_broken_documents_raise(tmp_path, text):
    path = write_json(tmp_path / "a.json", text)
    with pytest.raises(ValueError):
        list(json_walk.walk_rate_file(path, ".*"))


def test_codes_are_read_lazily(tmp_path):
    text = json.dumps(INLINE_DOC)[:-40] + "broken"
    path = write_json(tmp_path / "a.json", text)
    assert next(json_walk.walk_codes(path)) == "97155"


def test_key_far_before_its_array():
    from ratescape.sources.json_walk import _key_before

    text = b'{"a\\"b"' + b" " * 900 + b":" + b"\n" * 700 + b"[1]"
    assert _key_before(text, 0, text.index(b"[")) == 'a"b'
    assert _key_before(b"[[", 0, 1) is None and _key_before(b'{"\\\\":[', 0, 6) == "\\"
