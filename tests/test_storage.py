"""Storage use by folder level against a walk over the same files."""

import os

from lakeload.operators import storage


def test_sizes(spark, tmp_path):
    root = tmp_path / "a(b)" / "landing"
    sizes = {}
    for source, year, month, n in (("crm", "2024", "01", 10), ("crm", "2024", "02", 20), ("erp", "2025", "01", 5)):
        for run in ("r1", "r2"):
            folder = root / source / year / month / "05" / run / "orders"
            folder.mkdir(parents=True)
            (folder / "part-0.parquet").write_bytes(b"x" * n)
            sizes[source, year, month] = sizes.get((source, year, month), 0) + n
    (root / "crm" / "note.txt").write_bytes(b"123")
    files = storage.file_sizes(spark, str(root))
    walked = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if not f.startswith("."))
    assert storage.size_totals(storage.size_by_level(files, 1)).first().size_bytes == walked
    by_month = {r.folder: (r.size_bytes, r.n_files) for r in storage.size_by_level(files, 3).collect()}
    assert by_month == {**{"/".join(k): (v, 2) for k, v in sizes.items()}, "crm": (3, 1)}
    chosen = storage.filter_levels(files, {2: "2024", 3: "01"})
    assert {r.folder for r in storage.size_by_level(chosen, 3).collect()} == {"crm/2024/01", "crm"}
    top = storage.largest_folders(storage.size_by_level(files, 3), 1).collect()
    assert [(r.folder, r.n_files) for r in top] == [("crm/2024/02", 2)]
