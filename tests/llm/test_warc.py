"""WARC: round trip, revisits, and recovery of damaged archives."""

import base64
import gzip
import hashlib

import pytest

from cohortlens.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, sha string, id string"


def pages():
    rows = [(i, f"http://h{i % 3}.example/é?q={i}\r\nx", f"<p>page {i % 7} ünï</p>" * (1 + i % 7)) for i in range(40)]
    rows += [(50, None, None), (51, "http://a", ""), (52, None, "\x00\x1f\x8b\x08 WARC/1.1\r\n binary-like"), (None, "u", "no id"),
             (53, "u", "big " * 100_000), (54, "u", "twice"), (54, "u", "twice")]
    return [(*r, "x", "y", "z") for r in rows]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    warc.write_archives(df, str(tmp_path / "a"))
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert all(r.kind == "record" for r in got)
    largest = {}
    for i, _, html, *_ in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    want = []
    for i, _, html, *_ in rows:
        first = largest.get(html or "")
        want.append((f"urn:page:{'' if i is None else i}", len((html or "").encode()), digest(html), "response" if i == first else "revisit",
                     None if i == first else f"urn:page:{first}"))
    assert sorted(((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        if r.record_type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest
    for f in (tmp_path / "a").glob("part-*"):  # any gzip reader takes the files
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")


def records(n):
    out = []
    for i in range(n):
        data = f"payload {i} ".encode() * 20
        out.append(warc.record_bytes("response", f"urn:page:{i}", "http://x", data, warc.sha1_base32(data), len(data), None))
    return out


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_finds_later_records_and_logs_gaps(zipped):
    parts = [warc.gzip_member(r) if zipped else r for r in records(8)]
    at = [sum(map(len, parts[:i])) for i in range(9)]
    data = bytearray(b"".join(parts))
    data[at[2] + len(parts[2]) // 2] ^= 0xFF       # a damaged byte in record 2
    data[at[5]:at[5] + 3] = b"???"                 # record 5 loses its begin
    data = bytes(data) + b"garbage" + parts[0][:-40]  # and the archive ends in a copy torn inside its record
    found = list(warc.salvage(data))
    ids = [x[3]["record_id"] for x in found if x[0] == "record"]
    assert ids == [f"urn:page:{i}" for i in (0, 1, 3, 4, 6, 7)]
    gaps = [(a, n) for kind, a, n, _ in found if kind == "gap"]
    assert (at[2], len(parts[2])) in gaps and (at[5], len(parts[5])) in gaps and gaps[-1] == (at[8], 7 + len(parts[0]) - 40)
    assert sum(x[2] for x in found if x[0] == "gap") + sum(len(parts[i]) for i in (0, 1, 3, 4, 6, 7)) == len(data)  # every byte is told


def test_wrong_digests_are_quarantined_and_plain_after_zip_is_read():
    good, bad = records(2)
    found = list(warc.salvage(warc.gzip_member(good) + bad.replace(b"payload 1", b"payload 9") + good + warc.gzip_member(b"no record")))
    assert [x[0] for x in found] == ["record", "gap", "record", "gap"] and "digest" in found[1][3]
    assert list(warc.salvage(b"")) == [] and [x[0] for x in warc.salvage(b"junk")] == ["gap"]


def test_good_records_of_a_damaged_member_are_kept():
    plain = records(8)
    plain[3] = plain[3].replace(b"payload 3", b"payload X")
    at = [sum(map(len, plain[:i])) for i in range(9)]
    one = warc.gzip_member(b"".join(plain))
    found = list(warc.salvage(one + warc.gzip_member(plain[0])))
    assert [x[3]["record_id"][9:] for x in found if x[0] == "record"] == list("01245670")
    assert [(x[3]["inner_offset"], x[1]) for x in found if x[0] == "record"] == [(at[i], 0) for i in (0, 1, 2, 4, 5, 6, 7)] + [(0, len(one))]
    (bad,) = [x for x in found if x[0] == "gap"]
    assert bad[1:3] == (0, len(plain[3])) and bad[3].inner_offset == at[3] and "digest" in bad[3]


@pytest.mark.parametrize("damage", ["torn", "flipped", "checksum"])
def test_records_before_a_broken_place_are_kept(damage):
    import os

    data = [os.urandom(30_000).hex().encode() for _ in range(8)]
    plain = [warc.record_bytes("response", f"urn:page:{i}", "http://x", d, warc.sha1_base32(d), len(d), None) for i, d in enumerate(data)]
    one, last = warc.gzip_member(b"".join(plain)), warc.gzip_member(records(1)[0])
    cut = {"torn": one[:len(one) * 3 // 4], "flipped": bytearray(one), "checksum": bytearray(one)}[damage]
    if damage == "flipped":
        cut[len(one) // 2:len(one) // 2 + 300] = bytes(300)
    if damage == "checksum":
        cut[-8] ^= 0xFF
    found = list(warc.salvage(bytes(cut) + last))
    ids = [x[3]["record_id"][9:] for x in found if x[0] == "record"]
    first = {"torn": 5, "flipped": 3, "checksum": 8}[damage]
    assert ids[:first] == list("01234567")[:first] and ids[-1] == "0" and len(ids) > first
    gap = next(x for x in found if x[0] == "gap")
    assert gap[1] == 0 and gap[3].inner_offset is not None


@pytest.mark.parametrize("trailer", ["cut", "flipped"])
def test_only_record_of_a_member_with_a_broken_trailer_is_kept(trailer):
    plain = records(3)
    parts = [warc.gzip_member(r) for r in plain]
    broken = parts[1][:-6] if trailer == "cut" else parts[1][:-7] + bytes([parts[1][-7] ^ 1]) + parts[1][-6:]
    found = list(warc.salvage(parts[0] + broken + parts[2]))
    assert [x[3]["record_id"] for x in found if x[0] == "record"] == [f"urn:page:{i}" for i in range(3)]
    (gap,) = [x for x in found if x[0] == "gap"]
    assert gap[1:3] == (len(parts[0]), 0) and gap[3].inner_offset == len(plain[1])
    bare = b"\r\n".join(x for x in plain[1].split(b"\r\n") if b"lock-Digest" not in x and b"ayload-Digest" not in x)
    found = list(warc.salvage(warc.gzip_member(bare)[:-6]))  # nothing tells whether its bytes are right
    assert [x[0] for x in found] == ["gap"]


def test_inner_offsets_are_told_by_the_reader(spark, tmp_path):
    plain = records(3)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(warc.gzip_member(plain[0] + plain[1].replace(b"payload 1", b"payload X") + plain[2]))
    got = [(r.kind, r.record_id, r.inner_offset) for r in warc.read_archives(spark, str(tmp_path / "a")).collect()]
    a, b = len(plain[0]), len(plain[0]) + len(plain[1])
    assert got == [("record", "urn:page:0", 0), ("gap", None, a), ("record", "urn:page:2", b)]


def test_large_record_ends_in_zero():
    import os

    m = warc.gzip_member(os.urandom(17 << 20))
    assert m[-1] == 0


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def test_bundles_bound_files_by_bytes():
    members = [bytes([i]) * n for i, n in enumerate([3, 3, 3, 20, 1, 10, 2])]
    made = list(warc.bundles(members, 8))
    assert [len(b) for b in made] == [9, 20, 1, 10, 2] and b"".join(made) == b"".join(members)
    assert list(warc.bundles([], 8)) == []


def test_files_of_several_bundles_hold_every_record(spark, tmp_path):
    rows = [(i, f"http://a/{i}", ("%d " % i) * (3000 if i % 7 == 0 else 30)) for i in range(60)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"),
                        bundle_bytes=1000, bundles_per_file=2)
    assert len(list((tmp_path / "w").glob("part-*"))) > 5
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {r["kind"] for r in got} == {"record"}
    assert sorted((r["record_id"], r["payload"].decode()) for r in got) == sorted((f"urn:page:{i}", h) for i, _, h in rows)
