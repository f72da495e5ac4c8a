import json

from conftest import SF0001

from tidewatch.__main__ import main
from tidewatch.session import scratch_path
from tidewatch.sources import tx, write_raw


def test_cli_setup_slide_verdict(spark, capsys):
    raw = scratch_path(spark, "cli-raw")
    write_raw(tx(spark, SF0001), raw)
    root = scratch_path(spark, "cli-root")
    assert main(["setup", "--raw", raw, "--root", root, "--month", "1995-01-01"]) == 0
    assert main(["slide", "--raw", raw, "--root", root, "--times", "2"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"version": 2, "start_date": "1995-01-15", "end_date": "1995-02-13"}
    assert main(["verdict", "--raw", raw, "--root", root]) == 0
    assert main(["run-slides", "--raw", raw, "--root", root, "--n", "3"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"version": 5, "start_date": "1995-02-05", "end_date": "1995-03-06"}
    assert main(["refresh", "--raw", raw, "--root", root]) == 0
