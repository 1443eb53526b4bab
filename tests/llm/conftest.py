import pytest


@pytest.fixture()
def tables(spark, tmp_path):
    """Write named rows as a table folder and return its path."""
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
