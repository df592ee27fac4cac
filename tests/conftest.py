import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from egoline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt")),
                           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield s
    s.stop()


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)
