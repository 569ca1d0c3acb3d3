"""The command line run."""

from __future__ import annotations

import os
import shutil

from tallyloom.__main__ import main


def test_run_writes_and_reports(spark, paths, tmp_path, capsys):
    folder = os.path.dirname(paths.feeds["aws_cur"])
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    for name in ("copilot_usage", "copilot_billing", "azure_ai", "aws_cur"):
        shutil.copy(f"{folder}/{name}.csv", feeds)
    shutil.copy(f"{folder}/usage.json", feeds / "anthropic_usage.json")
    shutil.copy(f"{folder}/cost.json", feeds / "anthropic_cost.json")
    shutil.copy(f"{folder}/periods.csv", feeds / "billing_period.csv")

    out = str(tmp_path / "out")
    # one cost result of each hour has no amount
    assert main([str(feeds), "--out", out, "--generic", "billing_period"]) == 1
    printed = capsys.readouterr().out
    assert "stg_anthropic_cost.amount_usd not_null: 2 rows" in printed
    counts = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("_provider").count().collect()}
    assert counts == {"anthropic": 18, "copilot": 5, "azure_ai": 2, "aws_cur": 5}

    assert main([str(feeds), "--provider", "aws_cur"]) == 0
    assert capsys.readouterr().out.strip().endswith("passed")


def test_run_reports_drift_and_age(spark, paths, tmp_path, capsys):
    folder = os.path.dirname(paths.feeds["aws_cur"])
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    shutil.copy(f"{folder}/cost.json", feeds / "anthropic_cost.json")
    text = open(f"{folder}/usage.json").read()
    (feeds / "anthropic_usage.json").write_text(text.replace('"web_search_requests"', '"calls": 1, "web_search_requests"'))
    (feeds / "invoice_detail.csv").write_text("InvoiceId,BilledCost\na,1.5\n")
    spark.sql("select 'b' as InvoiceId, 2.5D as BilledCost, 'x' as odd").write.parquet(
        str(feeds / "invoice_detail.parquet")
    )
    base = [str(feeds), "--provider", "anthropic"]
    assert main([*base, "--tags", "schema"]) == 1
    printed = capsys.readouterr().out
    assert "server_tool_use has unknown key calls" in printed and "not_null" not in printed
    assert main([*base, "--tags", "nosuch", "--freshness", "1000000"]) == 0
    printed = capsys.readouterr().out
    assert "pass   anthropic_cost" in printed
    assert main([*base, "--generic-parquet", "invoice_detail", "--tags", "schema"]) == 1
    printed = capsys.readouterr().out
    assert "invoice_detail: UNEXPECTED COLUMN: odd" in printed
    assert "invoice_detail: no column InvoiceIssueDate" in printed
