"""From measurement directories to image files and back."""

import json

import numpy as np
import pytest

from wellspan.plans.compile import compile_measurements
from wellspan.sources import catalog, files, tiff
from wellspan.sinks import experiments, explorer, images, previews, recompress
from wellspan.scratch import materialize

SPACE = 'xmlns:v="urn:example:vendor"'


def write(folder, begin, planes, channels=(1, 2), pixel=0.5, overlap=2):
    """A measurement of planes {(field, tile, t, ch, z, action): page}, with dark and flat references for channel 1."""
    folder.mkdir(parents=True)
    (folder / "p.wpi").write_text(f'<v:WellPlate {SPACE} v:Name="plate" v:Columns="12" v:Rows="8"/>')
    rows = []
    for i, ((field, tile, t, ch, z, action), page) in enumerate(planes.items()):
        (folder / f"i{i}.tif").write_bytes(page if isinstance(page, bytes) else tiff.encode(page, "none"))
        tiled = f'v:TileXIndex="{tile[0]}" v:TileYIndex="{tile[1]}" v:PartialTileIndex="1"' if tile else ""
        rows.append(f'<v:MeasurementRecord v:Type="IMG" v:Time="{begin[:17]}{t:02d}{begin[19:]}" v:Column="2" v:Row="1" v:TimePoint="{t}" v:TimelineIndex="1" v:X="0" v:Y="0" v:FieldIndex="{field}" {tiled} v:ZIndex="{z}" v:ActionIndex="1" v:Action="{action}" v:Z="0" v:Ch="{ch}">i{i}.tif</v:MeasurementRecord>')
    (folder / "MeasurementData.mlf").write_text(f"<v:MeasurementData {SPACE}>{''.join(rows)}</v:MeasurementData>")
    listed = "".join(f'<v:MeasurementChannel v:Ch="{c}" v:HorizontalPixelDimension="{pixel}" v:VerticalPixelDimension="{pixel}" v:CameraNumber="{c}" v:ShadingCorrectionSource="SC{c}.tif"/>' for c in channels)
    (folder / "MeasurementDetail.mrf").write_text(f'<v:MeasurementDetail {SPACE} v:BeginTime="{begin}" v:Title="t" v:MeasurementSettingFileName="s.mes">{listed}</v:MeasurementDetail>')
    line = f'<v:Timelapse><v:Timeline v:Name="line" v:InitialTime="0" v:Period="5" v:Interval="1" v:ExpectedTime="9"><v:PointSequence v:Method="PartialTiledPosition"><v:PartialTiledPosition v:OverlappingPixels="{overlap}"/></v:PointSequence></v:Timeline></v:Timelapse>'
    (folder / "s.mes").write_text(f'<v:MeasurementSetting {SPACE} v:Columns="12" v:Rows="8">{line}<v:ChannelList><v:Channel v:Ch="1" v:Magnification="20"/></v:ChannelList></v:MeasurementSetting>')


def page(seed, shape=(40, 48)):
    return np.random.default_rng(seed).integers(200, 5000, shape).astype(np.uint16)


def flat():
    return page(99), np.full((40, 48), 100, np.uint16)


@pytest.fixture
def root(tmp_path):
    frames = {(1, None, t, ch, z, "2D"): page(1000 * t + 100 * ch + z) for t in (1, 2) for ch in (1, 2) for z in (1, 2)}
    later = {(1, None, t, ch, z, "2D"): page(50_000 + 1000 * t + 100 * ch + z) for t in (1,) for ch in (1, 2) for z in (1, 2)}
    broken = {(2, None, 1, ch, 1, "2D"): (b"broken" if ch == 2 else page(7)) for ch in (1, 2)}
    lacking = {(3, None, t, ch, 1, "2D"): page(8) for t, ch in ((1, 1), (1, 2), (2, 1))}
    bright = {(4, None, 1, 1, z, "BF3D"): page(9 + z) for z in (1, 2, 3)}
    write(tmp_path / "in/a", "2024-05-01T10:00:00.0000000+00:00", frames | broken | lacking | bright)
    write(tmp_path / "in/b", "2024-05-02T10:00:00.0000000+00:00", later)
    f, d = flat()
    for name in ("a", "b"):
        (tmp_path / f"in/{name}/SC1.tif").write_bytes(tiff.encode(f))
        (tmp_path / f"in/{name}/DC_DCAM#1_CAM1.tif").write_bytes(tiff.encode(d))
    return tmp_path, frames, later, bright


def even(p):
    f, d = flat()
    ff = f.astype(float) - d
    gain = np.where(ff == 0, 0, ff.mean() / np.where(ff == 0, 1, ff))
    return np.clip((p.astype(float) - d) * gain, 0, 65535).astype(np.uint16)


def test_compile_both(spark, root):
    tmp, frames, later, bright = root
    out = str(tmp / "out")
    got = {(r["stack"], (r["path"] or "").rpartition(".")[2]): r for r in compile_measurements(spark, str(tmp / "in"), out, z_mode="mip", format="both", title="t").collect()}
    bad = {s: r["error"] for (s, _), r in got.items() if not r["success"]}
    assert set(bad) == {"t_A02_F02_L1_A1_2D_20x", "t_A02_F03_L1_A1_2D_20x"} and "3 planes found" in bad["t_A02_F03_L1_A1_2D_20x"]
    assert sorted((s, k) for (s, k), r in got.items() if r["success"]) == [(s, k) for s in ("t_A02_F01_L1_A1_2D_20x", "t_A02_F04_L1_A1_BF3D_20x") for k in ("tif", "zarr")]
    data = (tmp / "out/t_A02_F01_L1_A1_2D_20x.ome.tif").read_bytes()
    want = []
    for source, t in ((frames, 1), (frames, 2), (later, 1)):
        for ch in (1, 2):
            pages = [source[1, None, t, ch, z, "2D"] for z in (1, 2)]
            want.append(np.maximum(*[even(p) if ch == 1 else p for p in pages]))
    assert all(np.array_equal(a, b) for a, b in zip(tiff.decode_all(data), want, strict=True))
    meta = tiff.image_metadata(data)
    assert (meta["axes"], meta["sizes"]) == ("TCYX", [3, 2, 40, 48]) and meta["pixels"]["PhysicalSizeX"] == "0.5" and meta["pixels"]["PhysicalSizeXUnit"] == "µm"
    extras = json.loads(meta["description"])
    assert extras["WellID"] == "A02" and extras["ZMode"] == "mip" and extras["TimelinePeriod"] == 5 and extras["RelativeTimes"] == [0.0, 1.0, 86400.0]
    assert [p["DeltaT"] for p in meta["planes"]] == ["0.0", "0.0", "1.0", "1.0", "86400.0", "86400.0"] and meta["channels"] == ["Channel_1", "Channel_2"]
    assert [np.array_equal(a, b) for a, b in zip(tiff.decode_all((tmp / "out/t_A02_F04_L1_A1_BF3D_20x.ome.tif").read_bytes()), bright.values(), strict=True)] == [True] * 3
    zarr = f"{out}/t_A02_F01_L1_A1_2D_20x.ome.zarr"
    rows = {(r["t"], r["c"]): np.frombuffer(r["px"], "<u2").reshape(r["h"], r["w"]) for r in images.read_zarr_planes(spark, zarr, 1).collect()}
    assert all(np.array_equal(rows[i // 2, i % 2], p[::2, ::2]) for i, p in enumerate(want))
    entries = catalog.read_catalog(spark, out)
    got = {r["stem"]: r for r in entries.collect()}
    assert got["t_A02_F01_L1_A1_2D_20x"]["shape"] == [3, 2, 40, 48] and got["t_A02_F01_L1_A1_2D_20x"]["n_levels"] == 2 and got["t_A02_F01_L1_A1_2D_20x"]["well"] == "A02"
    text = open(explorer.write_explorer(entries, f"{out}/index.html")).read()
    assert "2 dataset(s), 1 well(s), 2 action(s); 96-well" in text
    # What is there is not made again.
    again = compile_measurements(spark, str(tmp / "in"), out, z_mode="mip", title="t").collect()
    assert sorted(r["stack"] for r in again) == ["t_A02_F02_L1_A1_2D_20x", "t_A02_F03_L1_A1_2D_20x"]


def test_brightest_slice_of_the_whole_stack(spark, root):
    tmp, frames, later, _ = root
    compile_measurements(spark, str(tmp / "in"), str(tmp / "out"), correct=False, no_merge=["2d"]).collect()
    pages = tiff.decode_all((tmp / "out/A02_F01_L1_A1_2D_20x_R00.ome.tif").read_bytes())
    best = max((1, 2), key=lambda z: np.mean([p for k, p in frames.items() if k[4] == z]))
    assert all(np.array_equal(a, b) for a, b in zip(pages, [p for k, p in frames.items() if k[4] == best], strict=True))
    assert len(tiff.decode_all((tmp / "out/A02_F01_L1_A1_2D_20x_R01.ome.tif").read_bytes())) == 2


def test_stitched(spark, tmp_path):
    whole = np.full((74, 90), 777, np.uint16)
    tiles = {(1, (x, y), 1, 1, 1, "2D"): whole[:40, :48] for x in (3, 5) for y in (2, 9)}
    write(tmp_path / "in/a", "2024-05-01T10:00:00+00:00", tiles, channels=(1,), overlap=6)
    rows = compile_measurements(spark, str(tmp_path / "in"), str(tmp_path / "out"), tile_mode="stitch", z_mode="keep").collect()
    assert [r["success"] for r in rows] == [True]
    assert np.array_equal(tiff.decode((tmp_path / "out/A02_M01_L1_A1_2D_20x.ome.tif").read_bytes()), whole)


def test_wrong_options(spark, tmp_path):
    write(tmp_path / "in/a", "2024-05-01T10:00:00+00:00", {(1, None, 1, 1, 1, "2D"): page(1)})
    for how in ({"z_mode": "max"}, {"format": "png"}, {"tile_mode": "x"}):
        with pytest.raises(ValueError):
            compile_measurements(spark, str(tmp_path / "in"), str(tmp_path / "out"), **how)
    with pytest.raises(ValueError, match="excluded"):
        compile_measurements(spark, str(tmp_path / "in"), str(tmp_path / "out"), exclude=["A/"])
    (tmp_path / "in/a/none").mkdir()
    with pytest.raises(ValueError, match="no measurement below"):
        compile_measurements(spark, str(tmp_path / "in/a/none"), str(tmp_path / "out"))


@pytest.mark.parametrize("compression", recompress.COMPRESSIONS)
def test_recompression(compression):
    film = np.stack([page(i, (33, 70)) for i in range(3)])
    data = tiff.encode(film, "none", tiff.ome_xml({"T": 3, "Y": 33, "X": 70}, PhysicalSizeXUnit="µm"), resolution=(2.5, 2.5), unit=3, big=True)
    small = tiff.recompressed(data, compression)
    assert all(np.array_equal(a, b) for a, b in zip(tiff.decode_all(small), film, strict=True))
    assert tiff.image_metadata(small)["axes"] == "TYX" and tiff.rational(tiff.tags(small)[1][282]) == 2.5


@pytest.mark.parametrize("n", [1, 253, 254, 255, 256, 300, 600, 2000, 60_000])
def test_lzw_round_trip(n):
    data = np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes()
    for raw in (data, b"a" * n, data[: n // 2] * 2):
        assert tiff._unlzw(tiff._lzw(raw)) == raw


def test_tiles():
    import struct

    image = page(3, (20, 30))
    tiles = [np.pad(image, ((0, 12), (0, 2)))[y : y + 16, x : x + 16].tobytes() for y in (0, 16) for x in (0, 16)]
    body = b"".join(tiles)
    fields = [(256, 4, 1, 30), (257, 4, 1, 20), (258, 3, 1, 16), (259, 3, 1, 1), (277, 3, 1, 1), (322, 4, 1, 16), (323, 4, 1, 16), (324, 4, 4, 8 + len(body)), (325, 4, 4, 24 + len(body))]
    data = struct.pack("<2sHI", b"II", 42, 40 + len(body)) + body + struct.pack("<4I", *[8 + 512 * i for i in range(4)]) + struct.pack("<4I", *[512] * 4)
    data += struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", *f) for f in fields) + struct.pack("<I", 0)
    assert np.array_equal(tiff.decode(data), image)


def test_archives(spark, tmp_path):
    import zipfile

    tif = tiff.encode(page(1), "none")
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        for name, content in (("d/a.TIFF", tif), ("d/note.txt", b"hi"), ("__MACOSX/d/a.tif", b"x"), ("d/", b"")):
            z.writestr(name, content)
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("ok.tif", tif)
        z.writestr("../out.txt", b"no")
    (tmp_path / "none.zip").write_bytes(b"not a zip")
    (tmp_path / "folder/sub").mkdir(parents=True)
    (tmp_path / "folder/sub/b.tif").write_bytes(tif)
    (tmp_path / "single.tif").write_bytes(tif)
    inputs = [str(tmp_path / n) for n in ("good.zip", "bad.zip", "none.zip", "folder", "single.tif", "missing")]
    out = tmp_path / "out"
    results, summary = recompress.compress_tiffs(spark, inputs, str(out), materialize, "zstd", delete_originals=True)
    assert summary == {"processed": 5, "succeeded": 3, "failed": 2, "deleted": 1}
    assert not (tmp_path / "good.zip").exists() and (tmp_path / "bad.zip").exists()
    assert sorted(str(p.relative_to(out)) for p in out.rglob("*") if p.is_file() and not p.name.startswith(".")) == ["bad/ok.tif", "folder/sub/b.tif", "good/d/a.tif", "good/d/note.txt", "single.tif"]
    assert results.where("success").count() == 5
    assert recompress.compress_tiffs(spark, [str(tmp_path / "missing")], str(out), materialize)[1]["failed"] == -1


def test_archive_directory_is_read_once(spark, tmp_path):
    """Members are read at their places: an archive whose directory is gone after the listing still gives them all."""
    import zipfile

    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i, kind in enumerate((zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)):
            z.writestr(f"d/é{i}.txt", b"words " * 50 * i, kind)
    work = materialize(recompress.jobs(spark, [str(path)]), "work")
    data = path.read_bytes()
    path.write_bytes(data[: data.index(b"PK\1\2")])
    done = materialize(recompress.process(work, str(tmp_path / "out")), "done").collect()
    assert sorted((r["member"], r["success"], r["output_size"]) for r in done) == [(f"d/é{i}.txt", True, 300 * i) for i in range(4)]
    assert (tmp_path / "out/a/d/é3.txt").read_bytes() == b"words " * 150
    path.write_bytes(data[:20])
    assert materialize(recompress.process(work, str(tmp_path / "short")), "short").where("success").count() == 0


def test_previews(spark, tmp_path):
    film = np.stack([page(i, (41, 60)) for i in range(5)])
    (tmp_path / "x_2D.ome.tif").write_bytes(tiff.encode(film))
    (tmp_path / "x_BF.ome.tif").write_bytes(tiff.encode(film))
    (tmp_path / "y_2D.ome.tif").write_bytes(b"broken")
    frames = materialize(previews.preview_frames(previews.films(spark, str(tmp_path))), "frames")
    lo, hi = np.percentile(film, (0.5, 99.5))
    want = [np.clip((f.astype(float) - lo) / (hi - lo) * 255, 0, 255).astype(np.uint8)[:40].reshape(20, 2, 30, 2).mean(axis=(1, 3)).astype(np.uint8) for f in film]
    got = frames.where("stem = 'x_2D'").orderBy("frame").collect()
    assert all(np.array_equal(np.frombuffer(r["px"], np.uint8).reshape(20, 30), w) for r, w in zip(got, want, strict=True))
    assert {r["stem"]: r["error"] for r in previews.film_results(frames).collect()} == {"x_2D": None, "y_2D": "not a TIFF"}


def test_experiments(tmp_path):
    given = {"user": "u", "project": "p", "instrument": "i", "modality": "m", "cell_type": "c", "well_type": "w", "replicate": 1}
    a, b = (experiments.register(str(tmp_path), given, created=c) for c in ("2024-01-01", "2025-01-01"))
    assert a == b and json.loads((tmp_path / a.rpartition("/")[2] / "metadata.json").read_text())["created"] == "2025-01-01"
    with pytest.raises(ValueError, match="User, Modality"):
        experiments.register(str(tmp_path), given | {"user": "", "modality": None})
    experiments.set_writable(a, False)
    experiments.set_writable(a, True)


def test_hidden_files(spark, tmp_path):
    (tmp_path / "x.ome.zarr/0").mkdir(parents=True)
    (tmp_path / "x.ome.zarr/.zattrs").write_text("{broken")
    (tmp_path / "x.analysis.html").write_text("")
    (tmp_path / "y.ome.zarr/0").mkdir(parents=True)
    (tmp_path / "y.ome.zarr/0/.zarray").write_text('{"shape": [4, 5], "dtype": "<u2"}')
    got = {r["stem"]: r for r in catalog.read_catalog(spark, str(tmp_path)).collect()}
    assert got["x"]["well"] == "unknown" and got["x"]["shape"] == [] and got["x"]["analysis_rel"] == "x.analysis.html" and got["y"]["shape"] == [4, 5]
    assert files.list_files(spark, str(tmp_path / "none")).count() == 0
