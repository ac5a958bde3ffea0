import json

import numpy as np
import pytest

from wellspan.operators.planes import exploded
from wellspan.sources import measurements, registry, tiff

SPACE = 'xmlns:v="urn:example:vendor"'


def measurement(folder, begin, setting="s.mes", kinds=("IMG", "SF"), detail=True):
    folder.mkdir(parents=True)
    (folder / "p.wpi").write_text(f'<v:WellPlate {SPACE} v:Name="plate" v:Columns="12" v:Rows="8"/>')
    rows = []
    for i, kind in enumerate(kinds):
        image = f'v:ZIndex="1" v:ActionIndex="1" v:Action="BF" v:Z="0.5" v:Ch="{i + 1}"' if kind == "IMG" else ""
        rows.append(f'<v:MeasurementRecord v:Type="{kind}" v:Time="{begin}" v:Column="2" v:Row="1" v:TimePoint="1" v:TimelineIndex="1" v:X="1.5" v:Y="2" v:FieldIndex="1" {image}>a {i}.tif</v:MeasurementRecord>')
    (folder / "MeasurementData.mlf").write_text(f"<v:MeasurementData {SPACE}>{''.join(rows)}</v:MeasurementData>")
    if detail:
        channel = '<v:MeasurementChannel v:Ch="1" v:HorizontalPixelDimension="0.65" v:CameraNumber="1"/>'
        (folder / "MeasurementDetail.mrf").write_text(f'<v:MeasurementDetail {SPACE} v:BeginTime="{begin}" v:Title="t" v:MeasurementSettingFileName="{setting}">{channel}</v:MeasurementDetail>')
    (folder / "s.mes").write_text(f'<v:MeasurementSetting {SPACE} v:Columns="12" v:Rows="8"><v:ChannelList><v:Channel v:Ch="1" v:Magnification="20"/></v:ChannelList></v:MeasurementSetting>')


def test_measurements(spark, tmp_path):
    measurement(tmp_path / "x/late", "2023-05-02T23:30:00.0000001+02:00")
    measurement(tmp_path / "x/early", "2023-05-02T21:00:00.0000000+00:00")
    measurement(tmp_path / "y/no detail", "2023-05-01T00:00:00+00:00", detail=False)
    measurement(tmp_path / "y/no_setting", "2023-05-01T00:00:00+00:00", setting="other.mes")
    measurement(tmp_path / "y/odd", "2023-05-01T00:00:00+00:00", kinds=("IMG", "XYZ"))
    measurement(tmp_path / "skipped", "2023-05-01T00:00:00+00:00")
    for name in ("late", "early"):
        (tmp_path / f"x/{name}/a 0.tif").write_bytes(tiff.encode(np.arange(6, dtype=np.uint16).reshape(2, 3) * 300))
    m = measurements.read_measurements(spark, str(tmp_path), exclude=["SKIPPED"])
    rejected = {r["base_path"].split("/")[-1]: r["reason"] for r in m.rejected.collect()}
    assert rejected == {"no detail": "no MeasurementDetail.mrf", "no_setting": "setting file missing", "odd": "record without a required value"}
    got = m.acquisitions.orderBy("acquisition_index").collect()
    assert [r["base_path"].split("/")[-1] for r in got] == ["early", "late"]
    assert got[0]["measurement_channel"][0]["ch"] == 1 and got[0]["setting"]["channel_list"]["channel"][0]["magnification"] == 20
    assert got[0]["well_plate"]["name"] == "plate"
    planes = tiff.planes_of(m.records.where("acquisition_index = 0"), "tif_path").select("h", "w", "px")
    assert sorted(r["v"] for r in exploded(planes).collect()) == [0, 300, 600, 900, 1200, 1500]
    assert m.records.count() == 2


def test_same_begin(spark, tmp_path):
    measurement(tmp_path / "a", "2023-05-02T12:00:00+00:00")
    measurement(tmp_path / "b", "2023-05-02T14:00:00+02:00")
    with pytest.raises(ValueError, match="Duplicate"):
        measurements.read_measurements(spark, str(tmp_path))


@pytest.mark.parametrize("compression", ["none", "zlib", "lzma", "zstd"])
@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.float32])
def test_tiff_round_trip(compression, kind):
    page = (np.arange(35).reshape(5, 7) * 7).astype(kind)
    data = tiff.encode(page, compression, "about")
    assert np.array_equal(tiff.decode(data), page) and tiff.tags(data)[1][270][0] == b"about\0"


def test_lzw():
    codes = [256, 7, 258, 8, 259, 257]  # 7, 77, 8, 778 by the rules of the format
    bits = "".join(f"{c:09b}" for c in codes)
    bits += "0" * (-len(bits) % 8)
    assert tiff._unlzw(int(bits, 2).to_bytes(len(bits) // 8, "big")) == bytes([7, 7, 7, 8, 7, 7, 8])


def test_broken_tiff(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(b"no")
    (tmp_path / "b.tif").write_bytes(tiff.encode(np.ones((2, 2), np.uint16), "none"))
    got = {r["path"][-5:]: r["error"] for r in tiff.read_tiffs(spark, str(tmp_path)).collect()}
    assert got == {"a.tif": "not a TIFF", "b.tif": None}


def test_registry(spark, tmp_path):
    for name, content in (("a", json.dumps({"experiment_id": "1", "created": "2024-01-01T00:00:00", "user": "u"})), ("b", "{broken"), ("c", json.dumps({"experiment_id": "2", "created": "2025-01-01T00:00:00"}))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(content)
    assert [r["folder"] for r in registry.read_experiments(spark, str(tmp_path)).collect()] == ["c", "a"]
