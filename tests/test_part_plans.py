from tests.test_part_views import _reads_whole


def test_f1_package_images(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_images")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f2_package_merge_overlaps(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_merge_overlaps")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f3_package_merges(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_merges")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f4_package_rows(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_rows")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f5_package_script(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_script")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f6_package_cells(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_cells")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f7_package_columns(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_columns")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f8_para_style_alloc(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "para_style_alloc")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f9_package_text(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_text")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f10_package_fill_runs(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_fill_runs")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f11_package_fill(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_fill")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f12_read_combined(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "read_combined")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f13_package_set_paragraph(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_set_paragraph")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f14_package_fields(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_fields")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f15_package_set_field(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "package_set_field")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan


def test_f16_insert_table(spark, monkeypatch):
    plan = _reads_whole(spark, monkeypatch, "insert_table")
    assert "MapInArrow" in plan and "BroadcastHashJoin" not in plan
