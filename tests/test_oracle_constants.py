"""The oracle's fixed values and the library's are stated apart and must agree."""


def test_fixed_values_agree():
    from txmon.functions import money, scoring
    from txmon.operators.rules import rule_rows
    from txmon.oracle import constants as c
    from txmon.sources import report
    assert c.FX == money.FX_RATES and len(c.FX) == 10
    assert c.CUSTOMER_NORM == scoring.CUSTOMER_RISK_NORM and c.GEO_NORM == scoring.GEO_RISK_NORM
    assert c.RULES == [(rid, name, cat, cond, sev) for rid, name, _, cat, cond, sev, _ in rule_rows()]
    assert c.TEXTS == report.DESCRIPTIONS and c.REPORT_RULES == report.REPORT_RULES


def test_oracle_does_not_import_the_library():
    """No module of the oracle takes anything from the code under test."""
    import pathlib
    import re
    folder = pathlib.Path(__file__).parent.parent / "txmon" / "oracle"
    for path in folder.glob("*.py"):
        for line in path.read_text().splitlines():
            if m := re.match(r"(?:from|import) (txmon[\w.]*)", line):
                assert m[1].startswith("txmon.oracle"), (path.name, line)
