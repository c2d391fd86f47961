import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import tracemalloc
import urllib.parse
import zlib

from scriptorium.llm import secret_scan as ss

KEY = "AKIA" + "B2" * 9
HEX = "0123456789abcdef" * 2


def brute(text):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans():
    for text in ("", "é token = 'abcdef' x", 'PassWord":"short', "apikey=123456api_key: " + HEX, KEY + "AKIA" + KEY, "toKen=abcdef", "ſecret=abcdef", "x" + HEX + "g" + HEX[:23], "secret = \n abcdefg", "password=token=abcdefgh"):
        assert ss.base_spans(text) == brute(text), text


def hidden(text, at):
    """All spans but base ones, which must be the given parts of the text."""
    more = [s for s in ss.all_spans(text) if s not in ss.base_spans(text)]
    return [(ss.KINDS[k], text[a:b]) for a, k, b in more] == at


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def test_layers_map_back():
    quoted = "".join(f"%{c:02X}" for c in KEY.encode())
    assert hidden(f"ñ {quoted} end", [("access", quoted)])
    assert hidden("see token%20%3D%20abcdef12 é", [("assign", "token%20%3D%20abcdef12")])
    assert hidden("see \\u0074oken=\\u00610bcdef ok", [("assign", "\\u0074oken=\\u00610bcdef")])
    assert hidden("a &#65;KIA" + KEY[4:] + " b", [("access", "&#65;KIA" + KEY[4:])])
    blob = b64("my password=hunter22 here")
    assert hidden(f"text {blob} more", [("assign", blob)])
    for packed in (gzip.compress, zlib.compress):
        blob = b64(packed(("x " + KEY).encode()))
        assert hidden(f"é {blob}.", [("access", blob)])
    nested = urllib.parse.quote(b64(b64(gzip.compress(f"token: {HEX}".encode()))), safe="")
    assert hidden(f"<{nested}>", [("assign", nested), ("hex", nested)])
    twice = "".join(f"%25{c:02X}" for c in KEY.encode())
    assert hidden(f"({twice})", [("access", twice)])


def test_fixpoint_ends():
    text = "%2525252525252541 " + b64(b64(b64("nothing to see here at all"))) + " 100%%% \\u12 %zz"
    assert ss.all_spans(text) == []
    raw = "plain words that never end " * 3
    for _ in range(30):
        raw = b64(raw) if len(raw) < 20000 else raw
    assert ss.all_spans(raw) == []


def test_whole_table(spark, tmp_path):
    rows = [(0, None), (1, ""), (2, f"é {KEY} token=abcdef {HEX}"), (2, f"é {KEY} token=abcdef {HEX}"), (3, "w " * 60000 + "secret=" + HEX)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = ss.query(spark, str(tmp_path)).collect()
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    for i, text in rows:
        want = ",".join(f"{ss.KINDS[k]}:{a}:{b}" for a, k, b in brute(text or ""))
        assert by[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert by[i].spans == want
        assert (by[i].n_assign, by[i].n_access, by[i].n_hex) == tuple(sum(k == n for _, k, _ in brute(text or "")) for n in range(3))


def test_decoded_layers_are_scanned_whole(monkeypatch):
    secret = f"key {KEY} end"
    for odd in ("\xa0", "\u200b", "\ufeff", "\xad", "\f", "\x1b", "\0"):
        blob = b64(f"a{odd} {secret}")
        assert hidden(f"text {blob} more", [("access", blob)])
    for raw in (b"\xff\xfe\x80 " + secret.encode(), secret.encode("utf-16"), secret.encode("utf-16-be"), b"z" + secret.encode("utf-16-le")):
        blob = b64(raw)
        assert hidden(f"text {blob} more", [("access", blob)])
    noise = random.Random(5).randbytes(300)
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        blob = b64(pack(b"nothing, at all") + pack(secret.encode()))
        assert hidden(f"text {blob} more", [("access", blob)])
        blob = b64(pack(pack(secret.encode())))
        assert hidden(f"text {blob} more", [("access", blob)])
        for width in (64, 76):
            raw = b64(pack(noise + secret.encode()))
            lines = "\r\n".join(raw[i : i + width] for i in range(0, len(raw), width))
            text = f"internationalization\n{lines}\n\nend"
            assert (text.index(lines), 1, text.index(lines) + len(lines)) in ss.all_spans(text)
    packed = gzip.compress(secret.encode(), mtime=0)
    for form in ("%{:02x}", "\\x{:02X}"):
        run = "".join(form.format(c) for c in packed)
        assert hidden(f"text {run} more", [("access", run)])
    monkeypatch.setattr(ss, "WINDOW", 1000)
    blob = b64(gzip.compress(("x, " * 1_000_000 + "token" + " " * 5000 + "= abcdef12 (" + "é" * 3000 + ") " + b64(b64(gzip.compress(("q, " * 900 + HEX).encode())))).encode()))
    assert hidden(f"text {blob} more", [("assign", blob), ("hex", blob)])


def test_payloads_after_a_sign_and_over_written_line_ends():
    blob = b64("my password=hunter22secret here")
    for before in ("see blob/", "x-", "a_", "https://host.example/path+"):
        assert hidden(before + blob, [("assign", blob)]), before
    packed = b64(gzip.compress(b"token=abcdefgh", mtime=0))
    for before in ("/usr/lib/", "usr/share/x/", "a-b_c/"):
        assert hidden(before + packed, [("assign", packed)]), before
    raw = b64(random.Random(1).randbytes(200) + f" {KEY} ".encode())
    for end in ("\\n", "\\r\\n", "\n"):
        text = '{"k": "' + end.join(raw[i : i + 60] for i in range(0, len(raw), 60)) + '"}'
        assert (7, 1, len(text) - 2) in ss.all_spans(text), end


def test_long_runs_take_linear_time_and_bounded_memory():
    blob = b64(gzip.compress(b"a" * 100_000_000))
    tracemalloc.start()
    began = time.monotonic()
    assert hidden("x " + blob, [("hex", blob)])
    took, peak = time.monotonic() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 60 and peak < 300_000_000, (took, peak)


def test_archive_in_a_run_longer_than_a_window(monkeypatch):
    monkeypatch.setattr(ss, "WINDOW", 100_000)
    monkeypatch.setattr(ss, "OVERLAP", 4_096)
    monkeypatch.setattr(ss, "PART", 10_000)
    noise = random.Random(2).randbytes(500_000)
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        inner = b64(pack(noise + b" token=abcdefgh " + noise[::-1] + f" {KEY}".encode()))
        blob = b64(pack(b"path/" + inner.encode() + b" " + HEX.encode()))
        assert hidden("x " + blob, [("assign", blob), ("access", blob), ("hex", blob)]), pack
        # Cut off, it still shows what could be unpacked; of bz2, whose blocks are whole or lost, that is nothing here.
        assert pack is bz2.compress or ("assign", blob[:-400_000]) in [(ss.KINDS[k], blob[a - 2 : b - 2]) for a, k, b in ss.all_spans("x " + blob[:-400_000])], pack


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ss.scan(empty).collect() == []
    odd = spark.createDataFrame([(1, f"x {KEY}", "b", "s"), (None, None, None, None)], "doc_id long, text string, base string, spans string")
    got = {r.doc_id: r for r in ss.scan(odd).collect()}
    assert [tuple(s) for s in got[1].spans] == [("access", 2, 24)] and got[None].spans == []
