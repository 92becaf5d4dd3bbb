"""Where staged tables go, by master and settings."""

import pytest

from checks.queries import QUERIES
from tallymark.operators import staging

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session as if on a cluster, without the setting of a folder."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    monkeypatch.setattr(staging, "FOLDER_SETTING", "tallymark.test.folder")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(staging, "_shared", set())
    yield spark
    spark.conf.unset("tallymark.test.folder")


@pytest.fixture
def warehouse(monkeypatch, cluster, tmp_path):
    monkeypatch.setattr(staging, "WAREHOUSE_SETTING", "tallymark.test.warehouse")
    cluster.conf.set("tallymark.test.warehouse", str(tmp_path))
    yield tmp_path
    cluster.conf.unset("tallymark.test.warehouse")


def test_warehouse_takes_the_place_of_the_setting(cluster, warehouse):
    assert staging.shared_folder(cluster) == f"file:{warehouse}"
    assert not list(warehouse.iterdir())


@pytest.mark.parametrize("name", ["booking_files", "ledger_rejects", "nearest_date_match", "shipment_detail", "written_flags"])
def test_queries_on_a_cluster_without_the_setting(cluster, warehouse, name):
    assert QUERIES[name](cluster, FOLDER).count() > 0
    assert list(warehouse.iterdir())


def test_plain_path_lies_in_the_default_file_system(cluster, tmp_path):
    cluster.conf.set("tallymark.test.folder", f"{tmp_path}/")
    assert staging.shared_folder(cluster) == f"file:{tmp_path}"


ON_A_PLAIN_PATH = [
    "booking_files",
    "csv_payments",
    "csv_reimbursements",
    "csv_returns",
    "detail_flags",
    "inventory_reimbursement",
    "ledger_good_lines",
    "ledger_rejects",
    "ledger_with_header_text",
    "nearest_date_match",
    "returned_to_inventory",
    "union_ledgers",
    "shipment_detail",
    "written_flags",
    "written_report",
    "written_detail",
    "written_packing",
]


@pytest.mark.parametrize("name", ON_A_PLAIN_PATH)
def test_queries_on_a_cluster_with_a_plain_path(cluster, tmp_path, name):
    cluster.conf.set("tallymark.test.folder", str(tmp_path))
    assert QUERIES[name](cluster, FOLDER).count() > 0
    assert list(tmp_path.iterdir())


def test_checkpoint_folder_of_the_context(cluster, warehouse, tmp_path_factory, monkeypatch):
    place = tmp_path_factory.mktemp("checkpoint")
    monkeypatch.setattr(type(cluster.sparkContext), "getCheckpointDir", lambda self: f"file:{place}")
    assert staging.shared_folder(cluster) == f"file:{place}"


def test_named_file_system_is_kept(cluster):
    for folder in ("hdfs://name/at", "file:/at"):
        cluster.conf.set("tallymark.test.folder", folder)
        assert staging.shared_folder(cluster) == folder


def test_missing_parts_raise(cluster, warehouse, monkeypatch):
    reader = type(cluster.read)
    whole = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths: whole(self, *paths).where("id > 0"))
    with pytest.raises(ValueError, match="shared by all executors"):
        staging.shared_folder(cluster)
