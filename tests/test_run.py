from __future__ import annotations

import json
import os

import pyarrow.parquet as pq
import pytest

from setlake import cli
from setlake.functions.predicates import Identity
from setlake.plans import stages
from setlake.plans.extract import ExtractionError, Snapshot, Source, extract_all
from setlake.schemas import OVERLAP, SUMMARY, arrow
from setlake.sinks import atomic
from setlake.sources.pbf import PBFReadError
from setlake.streaming.universe import grow_universe
from tests.support import parquet, pbf, tree


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    paths = tree(tmp_path_factory.mktemp("run"))
    return paths, stages.run_analysis(spark, paths, "r", workers=2)


def test_whole_run(done):
    paths, result = done
    assert result.overlap.summary == {"neither": 1, "website_only": 1, "wikidata_only": 1, "both": 1} and result.overlap.row_count == 4
    assert result.extraction.occurrence_count == 5
    assert [p.name for p in result.overlap.paths] == [f"shard-{i:02d}.parquet" for i in range(64)]
    tables = [pq.read_table(p) for p in result.overlap.paths]
    assert all(t.schema.remove_metadata().equals(arrow(OVERLAP)) for t in tables)
    rows = {(r["osm_type"], r["osm_id"]): r["overlap_category"] for t in tables for r in t.to_pylist()}
    assert rows == {("way", 1): "neither", ("way", 2): "website_only", ("relation", 5): "wikidata_only", ("relation", 6): "both"}
    summary = pq.read_table(result.overlap.summary_path)
    assert summary.schema.remove_metadata().equals(arrow(SUMMARY)) and summary["percentage"].to_pylist() == [25.0] * 4
    assert summary["overlap_category"].to_pylist() == ["neither", "website_only", "wikidata_only", "both"]
    manifest = json.loads(result.manifest_path.read_text())
    assert manifest["row_counts"] == {"raw_universe": 4, "website": 3, "wikidata": 2} and manifest["source_pbf_count"] == 2 and manifest["scanner_mode"] == "coverage-only"
    assert len(manifest["outputs"]) == 65 and "padded" not in result.manifest_path.read_text()
    assert sorted(p.name for p in result.run_root.iterdir()) == ["checkpoints", "coverage", "manifests", "members", "raw-identities"]
    assert not [p for p in result.run_root.rglob(".*")]
    assert pq.ParquetFile(result.overlap.summary_path).metadata.row_group(0).column(0).compression == "ZSTD"


def test_resume_reuses_everything_and_fresh_refuses(spark, done):
    paths, result = done
    files = [p for p in result.run_root.rglob("*.parquet")]
    before = {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in files}
    again = stages.run_analysis(spark, paths, "r", resume=True)
    assert again.overlap == result.overlap and {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in files} == before
    with pytest.raises(ExtractionError, match="already exists"):
        stages.run_analysis(spark, paths, "r")
    with pytest.raises(FileExistsError):
        stages.compute_overlap(spark, result.extraction.outputs, result.membership, result.run_root)


def test_checkpoints_notice_any_change(spark, tmp_path):
    paths = tree(tmp_path)
    result = extract_all(spark, paths, "r")
    source = Source(paths.raw_pbf_root / "a.osm.pbf", result.run_root)
    good = source.checkpoint.read_text()
    assert source.restore("coverage-only")[0] == 3 and source.restore("custom") is None
    for key, value in (("row_count", True), ("row_count", -1), ("sha256", ""), ("source_pbf", "b"), ("output", None), ("size_bytes", 1)):
        source.checkpoint.write_text(json.dumps(json.loads(good) | {key: value}))
        assert source.restore("coverage-only") is None
    source.checkpoint.write_text("[]")
    assert source.restore("coverage-only") is None
    source.checkpoint.write_text(good)
    os.utime(source.path, ns=(1, 1))
    assert source.restore("coverage-only") is None
    output = source.output.read_bytes()
    source.output.write_bytes(output[:-1] + bytes([output[-1] ^ 1]))
    assert source.restore("coverage-only") is None
    (paths.raw_pbf_root / "a.osm.pbf").write_bytes(pbf([(8, [1, 2, 3, 1])]))
    again = extract_all(spark, paths, "r", resume=True)
    assert again.occurrence_count == 3 and pq.read_table(source.output).to_pylist() == [{"osm_type": "way", "osm_id": 8}]


def test_files_of_removed_sources_are_not_classified(spark, tmp_path):
    paths = tree(tmp_path)
    first = stages.run_analysis(spark, paths, "r")
    (paths.raw_pbf_root / "b.osm.pbf").unlink()
    again = stages.run_analysis(spark, paths, "r", resume=True)
    assert (first.overlap.row_count, again.overlap.row_count) == (4, 3)


def test_custom_scanner_and_empty_source(spark, tmp_path):
    paths = tree(tmp_path)

    def scanner(path, callback):
        if path.name.startswith("a"):
            callback(Identity("way", 42))

    result = extract_all(spark, paths, "r", scanner=scanner)
    assert result.occurrence_count == 1 and [pq.read_metadata(p).num_rows for p in result.outputs] == [1, 0]
    assert json.loads((result.run_root / "checkpoints" / "a.json").read_text())["scanner_mode"] == "custom"
    with pytest.raises(ExtractionError, match="default scanner"):
        extract_all(spark, paths, "s", scanner=scanner, workers=2)
    for workers in (0, 9):
        with pytest.raises(ValueError):
            extract_all(spark, paths, "s", workers=workers)


def test_extraction_errors(spark, tmp_path):
    paths = tree(tmp_path)
    for path in paths.raw_pbf_root.iterdir():
        path.unlink()
    with pytest.raises(ExtractionError, match="no regular PBF"):
        extract_all(spark, paths, "r")
    (paths.raw_pbf_root / "bad.osm.pbf").write_bytes(b"\x00\x00\x00\x05x")
    with pytest.raises(Exception, match="cannot read PBF"):
        extract_all(spark, paths, "r")


@pytest.mark.parametrize("workers", [1, 3])
def test_a_damaged_file_costs_only_itself(spark, tmp_path, workers):
    paths = tree(tmp_path)
    (paths.raw_pbf_root / "aa.osm.pbf").write_bytes(pbf([(8, [1, 2, 3, 1])])[:-5])
    with pytest.raises(PBFReadError, match="aa.osm.pbf"):
        extract_all(spark, paths, "r", workers=workers)
    root = paths.run_root("r")
    assert sorted(p.name for p in (root / "checkpoints").iterdir()) == ["a.json", "b.json"]
    kept = {n: (root / "raw-identities" / f"{n}.parquet").stat().st_mtime_ns for n in "ab"}
    (paths.raw_pbf_root / "aa.osm.pbf").write_bytes(pbf([(8, [1, 2, 3, 1])]))
    again = extract_all(spark, paths, "r", workers=workers, resume=True)
    assert [p.name for p in again.outputs] == ["a.parquet", "aa.parquet", "b.parquet"] and again.occurrence_count == 6
    assert kept == {n: (root / "raw-identities" / f"{n}.parquet").stat().st_mtime_ns for n in "ab"}


def test_another_ring_rule_scans_again(spark, tmp_path):
    paths = tree(tmp_path)
    (paths.raw_pbf_root / "a.osm.pbf").write_bytes(pbf([(1, [1, 2, 3, 1]), (2, [1, 2, 1, 3, 4, 1])]))
    first = stages.run_analysis(spark, paths, "r")
    again = stages.run_analysis(spark, paths, "r", resume=True, ring_rule="distinct3")
    assert (first.extraction.occurrence_count, again.extraction.occurrence_count) == (3, 4)
    assert json.loads(again.manifest_path.read_text())["scanner_mode"] == "coverage-only:distinct3"
    back = stages.run_analysis(spark, paths, "r", resume=True)
    assert back.extraction.occurrence_count == 3 and back.overlap.row_count == first.overlap.row_count


def test_scanner_errors_and_many_keys(spark, tmp_path):
    paths = tree(tmp_path)

    def many(path, callback):
        for i in range(1, 250_001):
            callback(Identity("way", i))

    assert extract_all(spark, paths, "m", scanner=many).occurrence_count == 500_000

    def broken(path, callback):
        callback(Identity("way", 1))
        raise PBFReadError(f"cannot read {path.name} any more")

    with pytest.raises(PBFReadError, match="cannot read a.osm.pbf any more"):
        extract_all(spark, paths, "n", scanner=broken)


def test_row_groups_are_bounded(spark, tmp_path):
    paths = tree(tmp_path)
    (paths.raw_pbf_root / "a.osm.pbf").write_bytes(pbf([(i, [1, 2, 3, 1]) for i in range(1, 1001)]))
    result = extract_all(spark, paths, "r", batch_rows=100)
    meta = pq.read_metadata(result.outputs[0])
    assert meta.num_rows == 1000 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 100


def test_overlap_input_errors(spark, tmp_path, done):
    _, result = done
    raw, members = result.extraction.outputs, result.membership
    with pytest.raises(ValueError, match="two memberships, not 1"):
        stages.compute_overlap(spark, raw, stages.MembershipResult(members.paths[:1], members.manifest_path), tmp_path)
    with pytest.raises(stages.OverlapError, match="no such membership file"):
        stages.compute_overlap(spark, raw, stages.MembershipResult((members.paths[0], tmp_path / "no"), members.manifest_path), tmp_path)
    odd = parquet(tmp_path / "odd.parquet", [{"osm_type": "way", "osm_id": "x"}])
    with pytest.raises(stages.OverlapError, match="not a membership table"):
        stages.compute_overlap(spark, raw, stages.MembershipResult((members.paths[0], odd), members.manifest_path), tmp_path)
    with pytest.raises(stages.OverlapError, match="no file of raw identities"):
        stages.compute_overlap(spark, [], members, tmp_path)


def test_atomic_helpers(tmp_path):
    path = tmp_path / "x" / "a.json"
    atomic.write_json(path, {"b": 1, "a": "é"})
    assert path.read_text() == '{\n  "a": "é",\n  "b": 1\n}\n' and atomic.stored_object(path) == {"a": "é", "b": 1}
    with pytest.raises(TypeError):
        atomic.put(path, "no bytes")
    assert json.loads(path.read_text())["b"] == 1 and [p.name for p in path.parent.iterdir()] == ["a.json"]
    for bad in (b"\xff", b"{", b"[1]"):
        path.write_bytes(bad)
        assert atomic.stored_object(path) is None
    assert atomic.stored_object(tmp_path / "none") is None


def test_snapshot(tmp_path):
    path = tmp_path / "a"
    path.write_bytes(b"1")
    before = Snapshot.read(path)
    assert before.unchanged(Snapshot.stat_only(path)) and before.unchanged(Snapshot.read(path))
    path.write_bytes(b"12")
    assert not before.unchanged(Snapshot.stat_only(path))


def test_cli(spark, tmp_path, capsys):
    paths = tree(tmp_path)
    roots = ["--data-root", str(paths.data_root), "--raw-pbf-root", str(paths.raw_pbf_root), "--wikidata-root", str(paths.wikidata_root), "--website-root", str(paths.website_root)]
    assert cli.main(["preflight", *roots]) == 0
    out = capsys.readouterr().out.splitlines()
    assert out[1] == "raw PBF files: 2" and out[2].startswith("a.osm.pbf\t") and not paths.data_root.exists()
    assert cli.main(["run", *roots, "--run-id", "c"]) == 0
    assert "raw polygon universe: 4" in capsys.readouterr().out
    for bad in (["run", *roots, "--run-id", "c", "--workers", "9"], ["run", *roots, "--run-id", "c", "--batch-rows", "0"], ["preflight", *roots[:-1], str(tmp_path / "none")]):
        with pytest.raises(SystemExit):
            cli.main(bad)


def test_stream_takes_in_new_files_once(spark, tmp_path):
    folder, output, checkpoint = (str(tmp_path / x) for x in ("raw", "out", "ck"))
    schema = {"osm_type": "string", "osm_id": "int64"}
    parquet(tmp_path / "raw" / "a.parquet", [{"osm_type": "way", "osm_id": i} for i in (1, 2, 2)], schema)
    grow_universe(spark, folder, output, checkpoint).awaitTermination()
    parquet(tmp_path / "raw" / "b.parquet", [{"osm_type": "way", "osm_id": i} for i in (2, 3)], schema)
    grow_universe(spark, folder, output, checkpoint).awaitTermination()
    assert sorted(r.osm_id for r in spark.read.parquet(output).collect()) == [1, 2, 3]


def test_small_files_are_one_job_and_damage_is_halved_out(spark, tmp_path, monkeypatch):
    from setlake.plans import extract

    paths = tree(tmp_path)
    for i in range(9):
        (paths.raw_pbf_root / f"c{i}.osm.pbf").write_bytes(pbf([(8, [1, 2, 3, 1])]) if i != 5 else b"damaged")
    lots = []
    monkeypatch.setattr(extract, "_extract", lambda spark, group, *more, own=extract._extract: lots.append(len(group)) or own(spark, group, *more))
    monkeypatch.setattr(extract, "sha256", None)  # tasks have their own; the driver digests nothing
    with pytest.raises(PBFReadError, match="c5.osm.pbf"):
        extract_all(spark, paths, "r")
    assert lots[0] == 11 and len(lots) <= 9 and len(list((paths.run_root("r") / "checkpoints").iterdir())) == 10
    (paths.raw_pbf_root / "c5.osm.pbf").write_bytes(pbf([(9, [1, 2, 3, 1])]))
    lots.clear()
    assert extract_all(spark, paths, "r", resume=True).occurrence_count == 14 and lots == [1]
    sources = [Source(p, tmp_path) for p in sorted(paths.raw_pbf_root.iterdir())]
    size = sources[0].path.stat().st_size
    monkeypatch.setattr(extract, "GROUP_BYTES", 3 * size)
    assert all(len(g) >= 2 for g in extract._groups(sources, 2, False)[:-1]) and len(extract._groups(sources, 1, True)) == 11
    monkeypatch.setattr(extract, "GROUP_FILES", 4)
    monkeypatch.setattr(extract, "GROUP_BYTES", 1 << 40)
    assert [len(g) for g in extract._groups(sources, 1, False)] == [4, 4, 3]
