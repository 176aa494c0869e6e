"""The command line drives the job and the upkeep steps, and prints every row."""

from __future__ import annotations

import json

from conftest import DATA
from strata.__main__ import main
from strata.sinks import tables as T


def test_cli_run_and_upkeep(spark, tmp_path, capsys):
    root = str(tmp_path / "wh")
    assert main(["run", "--source", DATA, "--root", root, "--format", "text",
                 "--bronze-tasks", "3"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert {(x["phase"], x["table_name"]): x["row_count"] for x in lines}[
        ("gold", "top_customers")] == 10 and len(lines) == 6
    assert main(["compact", "--root", root, "--layer", "silver", "--table", "orders",
                 "--partition-by", "order_year"]) == 0
    capsys.readouterr()
    assert T.read_current(spark, root, "silver", "orders").count() == 10
    assert main(["copy", "--root", root, "--to", str(tmp_path / "copy")]) == 0
    copied = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert len(copied) == 6 and all(x["same_rows"] for x in copied)
