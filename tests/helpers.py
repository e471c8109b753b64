"""What several test modules import; fixtures are in conftest.py."""

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
