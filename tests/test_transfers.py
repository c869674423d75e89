"""Both ends of an exchange over real files, run more than once."""

import datetime as dt
import gzip
import hashlib
import io
import json
import os
import tarfile

import pyarrow as pa
import pytest

from tidegate.operators.aggregates import status_counts
from tidegate.operators.integrity import build_manifests
from tidegate.plans.transfers import receive_transfers, send_files
from tidegate.sinks.transfers import read_markers
from tidegate.sources import files as sources, large_files


def archive(members, symlink=False):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
        if symlink:
            info = tarfile.TarInfo("link")
            info.type, info.linkname = tarfile.SYMTYPE, "/etc/passwd"
            tar.addfile(info)
    return buffer.getvalue()


def manifest(session, body, receiver="hub", **changes):
    entry = {"zip_file_name": "transfer.tar.gz", "zip_file_size_bytes": len(body),
             "checksum_sha256": hashlib.sha256(body).hexdigest()}
    document = {
        "manifest_version": "1.0", "transfer_session_id": session, "sender_agency": "dot", "receiver_agency": receiver,
        "checksum_algorithm": "sha256", "compression_type": "gzip", "total_file_count": 2,
        "files": [{"file_name": "data.csv", "file_size_bytes": 3, "checksum_sha256": "a" * 64}, entry], "note": "extra"}
    return json.dumps({**document, **changes}, indent=2)


def put(root, agency, session, body, document):
    folder = os.path.join(root, agency, session)
    os.makedirs(folder)
    with open(os.path.join(folder, "transfer.tar.gz"), "wb") as f:
        f.write(body)
    if document is not None:
        with open(os.path.join(folder, "manifest.json"), "w") as f:
            f.write(document)


@pytest.mark.parametrize("wave", [4])
def test_receive(spark, tmp_path, wave):
    landing, target, markers = (str(tmp_path / name) for name in ("landing", "target", "markers"))
    good = archive([("data.csv", b"a,b\n"), ("sub/more.json", b"{}")], symlink=True)
    put(landing, "dot", "s-good", good, manifest("s-good", good))
    put(landing, "dot", "s-sum", good, manifest("s-other", good))
    put(landing, "north", "s-receiver", good, manifest("s-receiver", good, "elsewhere"))
    put(landing, "north", "s-count", good, manifest("s-count", good, total_file_count=3))
    put(landing, "north", "s-nomanifest", good, None)
    put(landing, "north", "s-broken", good, "{")
    bad = archive([("data.csv", b"virus")])
    put(landing, "north", "s-infected", bad, manifest("s-infected", bad))
    escaping = archive([("ok.txt", b"1"), ("../../evil", b"2")])
    put(landing, "dot", "s-escape", escaping, manifest("s-escape", escaping))
    put(landing, "dot", "s-nogzip", b"not an archive", manifest("s-nogzip", b"not an archive"))
    blocklist = spark.createDataFrame([(hashlib.sha256(b"virus").hexdigest(),)], "sha256 string")

    log = str(tmp_path / "audit")

    def run():
        routed = receive_transfers(spark, landing, target, markers, blocklist, "hub", wave, audit_path=log)
        return {r["session"]: (r["status"], r["reason"]) for r in routed.collect()}

    expected = {
        "s-good": ("processed", None), "s-sum": ("failed", "session_mismatch"), "s-receiver": ("failed", "receiver_mismatch"),
        "s-count": ("failed", "count_mismatch"), "s-nomanifest": ("failed", "manifest_missing"),
        "s-infected": ("rejected", "infected"), "s-escape": ("failed", "scan_error"), "s-nogzip": ("failed", "scan_error")}
    first = run()
    assert first.pop("s-broken")[0] == "failed"
    assert first == expected
    events = spark.read.json(log).collect()
    assert {(r["event_type"], r["outcome"]) for r in events if r["transfer_session_id"] == "s-infected"} == {
        ("extract_data", "success"), ("validate_manifest", "success"), ("decompress", "success"),
        ("virus_scan", "failure"), ("store_data", "failure")}
    assert [r["outcome"] for r in events if r["transfer_session_id"] == "s-good"] == ["success"] * 5
    stored = spark.read.parquet(target)
    assert {(r["agency"], r["session"], r["member"]) for r in stored.collect()} == {
        ("dot", "s-good", "data.csv"), ("dot", "s-good", "sub/more.json")}
    kinds = {r["session"]: r["kind"] for r in read_markers(spark, markers).collect()}
    assert kinds == {"s-good": "done", "s-infected": "rejected"}
    second = run()
    assert second["s-good"] == ("already_processed", "done") and second["s-infected"] == ("already_processed", "rejected")
    assert second["s-sum"] == ("failed", "session_mismatch")
    assert spark.read.parquet(target).count() == 2 and read_markers(spark, markers).count() == 2


def test_send_then_receive(spark, tmp_path):
    outgoing, staging, target = (str(tmp_path / name) for name in ("out", "landing", "target"))
    sent, received = str(tmp_path / "sent"), str(tmp_path / "received")
    folder = os.path.join(outgoing, "file_mode", "outgoing", "deep")
    os.makedirs(folder)
    bodies = {f"f{i}.txt": f"body {i} é".encode() for i in range(5)}
    for name, body in bodies.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(body)
    with open(os.path.join(folder, "f9.txt.done"), "wb") as f:
        f.write(b"marker")
    manifests = send_files(spark, outgoing, staging, sent, "dot", "hub", wave_transfers=2)
    assert manifests.count() == 5 and manifests.where("total_file_count = 2").count() == 5
    assert send_files(spark, outgoing, staging, sent, "dot", "hub").count() == 0
    none = spark.createDataFrame([], "sha256 string")
    routed = receive_transfers(spark, staging, target, received, none, "hub")
    assert {r["status"] for r in routed.collect()} == {"processed"}
    stored = {r["member"]: bytes(r["content"]) for r in spark.read.parquet(target).collect()}
    assert stored == bodies
    again = receive_transfers(spark, staging, target, received, none, "hub")
    assert status_counts(again).first().asDict() == {
        "processed": 0, "already_processed": 5, "failed": 0, "outcome": "success"}


def test_manifests_carry_their_times(spark):
    row = ("dot", "s", "a.csv", 1, "aa", "a.tar.gz", 2, "bb", dt.datetime(2026, 3, 4, 5, 6, 7, 8), "2026-03-05", None)
    names = "agency string, session string, source_name string, source_size bigint, source_sha256 string, archive_name string, " \
            "archive_size bigint, archive_sha256 string, created_at timestamp, transfer_date string, business_date date"
    made = build_manifests(spark.createDataFrame([row], names))
    assert made.first()["created_at"] == "2026-03-04T05:06:07.000008Z" and made.first()["transfer_date"] == "2026-03-05"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        now = build_manifests(spark.createDataFrame([row], names).drop("created_at")).first()["created_at"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs((dt.datetime.fromisoformat(now) - dt.datetime.now(dt.UTC)).total_seconds()) < 120


@pytest.mark.parametrize("name, escapes", [
    ("../x", True), ("/x", True), ("a/../b", False), (".", False), ("a/../../b", True), ("a/..b", False), ("..", True)])
def test_member_escape(name, escapes):
    assert sources.escapes_root(name) is escapes


def test_members_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sources, "PART_BYTES", 300)
    body = archive([("big", b"x" * 1000), ("small", b"y"), ("even", b"z" * 600), ("none", b"")])
    df = spark.createDataFrame([("s", bytearray(body)), ("n", None), ("bad", bytearray(gzip.compress(b"no tar")))], "k string, content binary")
    rows = sources.expand_archives(df, ["k"])
    joined = {}
    for r in sorted((r for r in rows.collect() if r["member"]), key=lambda r: r["part"]):
        joined[r["member"]] = joined.get(r["member"], b"") + bytes(r["content"])
    assert joined == {"big": b"x" * 1000, "small": b"y", "even": b"z" * 600, "none": b""}
    whole = {(r["k"], r["member"]): r for r in sources.whole_members(rows).collect()}
    assert {m: (r["size"], r["sha256"]) for (k, m), r in whole.items() if m} == {
        m: (len(b), hashlib.sha256(b).hexdigest()) for m, b in joined.items()}
    assert whole["n", None]["status"] == "no_content" and whole["bad", None]["status"] == "unreadable"


def test_archives_leave_in_batches_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(sources, "ARROW_BYTES", 10_000)
    made = []
    rows = ((n, made.append(n) or b"x" * 3_000) for n in range(20))
    sizes = []
    for batch in sources.arrow_batches(rows, pa.schema([("k", pa.int64()), ("archive", pa.binary())]), "archive"):
        sizes.append(batch.num_rows)
        assert len(made) == sum(sizes)  # nothing is made ahead
    assert sizes == [4] * 5


@pytest.mark.parametrize("agency, session", [("north east", "s 2"), ("a+b", "50% off"), ("büro", "%41 é")])
def test_folders_with_odd_names(spark, tmp_path, agency, session):
    landing, target, markers = (str(tmp_path / name) for name in ("landing", "target", "markers"))
    body = archive([("data.csv", b"a,b\n")])
    put(landing, agency, session, body, manifest(session, body, sender_agency=agency))
    none = spark.createDataFrame([], "sha256 string")
    for outcome in ("processed", "already_processed"):
        rows = receive_transfers(spark, landing, target, markers, none, "hub").collect()
        assert [(r["agency"], r["session"], r["status"]) for r in rows] == [(agency, session, outcome)]
    assert [(r["agency"], r["session"], r["member"]) for r in spark.read.parquet(target).collect()] == [(agency, session, "data.csv")]


def test_requested_objects_are_looked_up(spark):
    listing = spark.createDataFrame(
        [("b", "in/f.csv", 1), ("b", "in/f.csv", 1), ("b", "in/f.csv.done", 1), ("b", "in/", 0), ("b", "two/x", 2), ("b", "two/y/z", 3),
         ("b", "both", 4), ("b", "both/x", 5), ("c", "in/g", 6), ("b", "top", 7), (None, "in/h", 8)], "bucket string, key string, size bigint")
    wanted = {"s3://b/in/f.csv": ("ok", "in/f.csv"), "s3://b/in/": ("ok", "in/f.csv"), "s3://b/in": ("ok", "in/f.csv"), "s3://b/two/": ("several_objects", None),
              "s3://b/two/y": ("ok", "two/y/z"), "s3://b/both": ("ok", "both"), "s3://b/both/": ("ok", "both/x"), "s3://b/in/g": ("object_absent", None),
              "s3://b/in/f.csv.done": ("object_absent", None), "s3://b/top": ("ok", "top"), "s3://b/top/": ("object_absent", None), "s3://b": ("invalid", None),
              "s3://b/i": ("object_absent", None), None: ("missing_path", None)}
    requests = spark.createDataFrame([(uri, None) for uri in [*wanted, *wanted]], "uri string, name string")
    located = sources.locate_objects(sources.resolve_file_request(requests, "uri", "name"), listing)
    assert located.count() == 2 * len(wanted)
    assert {r["uri"]: (r["status"], r["source_key"]) for r in located.collect()} == wanted
    assert sources.locate_objects(sources.resolve_file_request(requests, "uri", "name"), listing.limit(0)).where("status = 'ok'").count() == 0


@pytest.mark.parametrize("part_bytes", [7, 32 << 20])
def test_one_layout_for_every_size(spark, tmp_path, monkeypatch, part_bytes):
    monkeypatch.setattr(sources, "PART_BYTES", part_bytes)
    outgoing, staging, target = (str(tmp_path / name) for name in ("out", "landing", "target"))
    folder = os.path.join(outgoing, "file_mode", "outgoing")
    os.makedirs(folder)
    bodies = {"small.txt": b"tiny", "large.bin": os.urandom(5_000), "medium.txt": b"x" * 50}
    for name, body in bodies.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(body)
    manifests = send_files(spark, outgoing, staging, str(tmp_path / "sent"), "dot", "hub")
    claimed = {r["files"][0]["file_name"]: (r["files"][0]["file_size_bytes"], r["files"][0]["checksum_sha256"]) for r in manifests.collect()}
    assert claimed == {name: (len(body), hashlib.sha256(body).hexdigest()) for name, body in bodies.items()}
    none = spark.createDataFrame([], "sha256 string")
    routed = receive_transfers(spark, staging, target, str(tmp_path / "received"), none, "hub")
    assert [r["status"] for r in routed.collect()] == ["processed"] * 3
    stored = {}
    for r in spark.read.parquet(target).orderBy("part").collect():
        stored[r["member"]] = stored.get(r["member"], b"") + bytes(r["content"])
    assert stored == bodies


def test_a_location_without_a_scheme_is_resolved_by_spark(spark):
    assert large_files.qualified(spark, "/landing/x").startswith("file:/")
    with pytest.raises(ValueError):
        large_files.open_store("/landing/x")
