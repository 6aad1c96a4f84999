"""WARC writer and salvage reader."""

import base64
import hashlib
import io
import random

from arlark.llm import warc

URL = "http://example.org/a b\r\nX"


def records(n=20, gzipped=True, seed=1):
    rng = random.Random(seed)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.randrange(400))) + b"\r\nWARC/1.1\r\n" * (i % 3 == 0) for i in range(n)]
    raw = [warc.make_record(i, URL, p, warc.base32_sha1(p), None) for i, p in enumerate(payloads)]
    return payloads, [warc.gzip_member(r) for r in raw] if gzipped else raw


def read(data):
    return list(warc.SalvageReader(io.BytesIO(data)))


def test_whole_archives_have_no_gaps():
    for gzipped in (True, False):
        payloads, parts = records(gzipped=gzipped)
        got = read(b"".join(parts))
        assert [g[0] for g in got] == ["record"] * len(parts)
        assert [g[3]["payload"] for g in got] == payloads
        assert got[0][3]["url"] == "http://example.org/a%20b%0D%0AX"
    assert read(b"") == []


def test_salvage_recovers_every_undamaged_record():
    for gzipped in (True, False):
        payloads, parts = records(gzipped=gzipped)
        begins = [sum(map(len, parts[:i])) for i in range(len(parts))]
        for seed in range(30):
            rng = random.Random(seed)
            data = bytearray(b"".join(parts))
            hurt = sorted(rng.sample(range(len(parts)), 3))
            for k in hurt:
                # the block of a record, or the first bytes of a member
                at = begins[k] + (rng.randrange(10) if gzipped else len(parts[k]) - 5)
                data[at] ^= 0x55
            got = read(bytes(data))
            assert {g[3]["page_id"] for g in got if g[0] == "record"} >= set(range(len(parts))) - set(hurt)
            for g in got:
                if g[0] == "record":
                    assert g[3]["payload"] == payloads[g[3]["page_id"]]
            # records and gaps tile the file
            assert [g[1] for g in got] == [0] + [g[2] for g in got[:-1]] and got[-1][2] == len(data)


def test_junk_between_and_around_members_is_one_gap_each():
    _, parts = records(4)
    junk = b"\x1f\x8b\x08 not a member"
    got = read(junk + parts[0] + parts[1] + junk * 2 + parts[2] + parts[3][:-9])
    assert [g[0] for g in got] == ["gap", "record", "record", "gap", "record", "gap"]
    assert got[0][2] == len(junk) and got[-1][3] == "member cut short"


def test_lengths_and_digests_are_checked():
    payload = b"body"
    wrong = warc.make_record(1, None, payload, warc.base32_sha1(b"other"), None)
    good = warc.make_record(2, None, payload, warc.base32_sha1(payload), None)
    got = read(wrong + good)
    assert [(g[0], g[3] if g[0] == "gap" else g[3]["page_id"]) for g in got] == [("gap", "payload digest is wrong"), ("record", 2)]
    long = good.replace(b"Content-Length: 83", b"Content-Length: 9999999")
    assert [g[0] for g in read(good.replace(b"WARC-Record-ID", b"WARC-Other-Name") + good)] == ["gap", "record"]
    assert long and [g[0] for g in read(good + b"WARC/1.1\r\nWARC-Type: response\r\n")] == ["record", "gap"]


def test_records_longer_than_a_read_step():
    payload = bytes(random.Random(2).randrange(256) for _ in range(300_000))
    for pack in (warc.gzip_member, lambda r: r):
        data = b"".join(pack(warc.make_record(i, None, payload, warc.base32_sha1(payload), None)) for i in range(3))
        assert [g[3]["payload"] == payload for g in read(data)] == [True] * 3


def test_headers_of_any_length_are_read():
    # blanks become %20; the lengths move the end of the headers over the borders of a read step
    for url in ["u" * 100_000, " " * 100_000, *("u" * (warc.STEP - k) for k in range(150, 350, 7))]:
        raw = [warc.make_record(i, url, b"body", warc.base32_sha1(b"body"), None) for i in range(2)]
        for parts in (raw, [warc.gzip_member(r) for r in raw]):
            got = read(b"".join(parts))
            assert [(g[0], g[3]["page_id"], g[3]["url"]) for g in got] == [("record", i, url.replace(" ", "%20")) for i in range(2)]
    # a record without an end of headers does not take the next one with it
    cut = b"WARC/1.1\r\nWARC-Target-URI: " + b"u" * 200_000 + b"\r\n"
    assert [g[0] for g in read(cut + raw[0])] == ["gap", "record"]


def test_a_member_longer_than_its_content_length_is_a_gap():
    good = warc.make_record(1, None, b"body", warc.base32_sha1(b"body"), None)
    got = read(warc.gzip_member(good + b"0" * 10_000_000) + warc.gzip_member(good))
    assert [g[0] for g in got] == ["gap", "record"] and got[0][3] == "block length is wrong"


def test_a_page_with_a_long_url_keeps_its_row(spark):
    pages = spark.createDataFrame([(1, "u" * 100_000, "a"), (2, "v", "a"), (3, " " * 30_000, "b")], "page_id long, url string, html string")
    for gzipped in (True, False):
        read = warc.read_warc(warc.write_warc(pages, gzipped=gzipped))
        assert sorted((r.page_id, len(r.url)) for r in warc.page_records(read).collect()) == [(1, 100_000), (2, 1), (3, 90_000)]
        assert warc.quarantined(read).count() == 0


def test_spark_round_trip(spark):
    rows = [(3, "u3", "same"), (1, None, "same"), (2, "u2", None), (5, "u5", ""), (9, "u9", "é 中\x00"), (None, "un", "alone"),
            (7, "u7", "x" * 200_000), (8, "u8", "same"), (8, "u8", "same")]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, file int, sha1 string")
    manifest = warc.write_warc(pages, archive_bytes=10_000)
    read = warc.read_warc(manifest)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.page_records(read).collect())
    first = {}
    for page_id, _, html in sorted(rows, key=lambda r: 10**9 if r[0] is None else r[0]):
        first.setdefault(html or "", page_id)
    expected = []
    for page_id, _, html in rows:
        body, lead = (html or "").encode(), first[html or ""]
        revisit = page_id is not None and page_id != lead
        expected.append((str(page_id), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                         "revisit" if revisit else "response", lead if revisit else None))
    assert got == sorted(expected)
    assert warc.quarantined(read).count() == 0
    plain = warc.write_warc(pages, gzipped=False, least_revisit_bytes=1)
    assert warc.page_records(warc.read_warc(plain)).where("record_type = 'revisit'").count() == 3
    assert warc.read_warc(warc.write_warc(pages.limit(0))).count() == 0


def _spoil_headers(rng, data, begins, ends):
    """Flips, cuts, replaces or repeats some bytes of one record's headers; returns the new bytes."""
    k = rng.randrange(len(begins))
    at = rng.randrange(begins[k], ends[k])
    span = rng.randrange(1, 9)
    new = {0: bytes(rng.randrange(256) for _ in range(span)), 1: b"", 2: "²".encode() * span, 3: b"9" * rng.choice([1, 30, 5000]),
           4: bytes([data[at] ^ (1 << rng.randrange(8))]), 5: b"\r\n", 6: b"\r\n folded", 7: b"\x1f\x8b\x08"}[rng.randrange(8)]
    stop = at + 1 if len(new) == 1 else min(at + span, len(data))
    return k, data[:at] + new + data[stop:]


def test_damaged_headers_never_stop_the_reader():
    """10,000 damages, plain and gzip: every intact record comes back, records and gaps tile the file."""
    for gzipped in (False, True):
        payloads = [f"payload number {i} ".encode() * (i + 1) for i in range(5)]
        raw = [warc.make_record(i, f"u{i}", p, warc.base32_sha1(p), None) for i, p in enumerate(payloads)]
        heads = [r.find(b"\r\n\r\n") + 4 for r in raw]
        for seed in range(5000):
            rng = random.Random(seed)
            if gzipped and seed % 2:
                # damage inside the packed header of a whole member
                k, part = _spoil_headers(rng, raw[0], [0], [heads[0]])
                which = rng.randrange(5)
                parts = [warc.gzip_member(r) for r in raw]
                hurt, parts[which] = which, warc.gzip_member(part)
                data = b"".join(parts)
            else:
                parts = [warc.gzip_member(r) for r in raw] if gzipped else raw
                begins = [sum(map(len, parts[:i])) for i in range(5)]
                ends = [b + (12 if gzipped else heads[i]) for i, b in enumerate(begins)]
                hurt, data = _spoil_headers(rng, b"".join(parts), begins, ends)
            got = read(data)
            assert [g[1] for g in got] == [0] + [g[2] for g in got[:-1]] and got[-1][2] == len(data)
            whole = [g[3]["payload"] for g in got if g[0] == "record"]
            # a header's damage may reach over the border into the next record's version line
            near = {hurt, hurt + 1} if not gzipped or seed % 2 == 0 else {hurt}
            assert all(p in whole for i, p in enumerate(payloads) if i not in near), (gzipped, seed)


def test_odd_digits_huge_numbers_and_folded_lines():
    good = warc.make_record(2, None, b"body", warc.base32_sha1(b"body"), None)
    length = good.partition(b"Content-Length: ")[2].partition(b"\r\n")[0]
    for bad in ("²".encode(), b"9" * 5000, b"-5", "٣".encode(), b"1e3"):
        for pack in (warc.gzip_member, lambda r: r):
            hurt = good.replace(b"Content-Length: " + length + b"\r\n\r\n", b"Content-Length: " + bad + b"\r\n\r\n", 1)
            assert hurt != good
            got = read(pack(hurt) + pack(good))
            assert [g[0] for g in got] == ["gap", "record"] and got[0][3] == "content-length is no number"
    for name, page in ((b"7" * 30, None), (b"9223372036854775807", 2**63 - 1), (b"9223372036854775808", None), (b"-3", -3), ("2²".encode(), None),
                       (b"uuid:ab-cd", None)):
        got = read(good.replace(b"urn:x-page:2>", b"urn:x-page:" + name + b">"))
        assert [(g[0], g[3]["page_id"]) for g in got] == [("record", page)]
    folded = good.replace(b"WARC-Date: 1970", b"X-Note: one\r\n two\r\n\tthree\r\nWARC-Date: 1970")
    for pack in (warc.gzip_member, lambda r: r):
        assert [g[0] for g in read(pack(folded) + pack(good))] == ["record", "record"]
    http = good.replace(b"Content-Length: 4\r\n", "Content-Length: ²\r\n".encode()[:19], 1)
    assert read(http)[0][0] in ("record", "gap")
