import os
import sys
import tempfile
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from callsight import schema as S  # noqa: E402
from callsight.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, "callsight-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="callsight-test-ckpt-"))
    yield s
    s.stop()


def ts(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


# Twelve golden rows (FIXTURES.md F1), raw, None = NULL.
GOLDEN = [
    (1, "C000000001", "A000000001", "llamada", "interesado", ts("2025-01-06 09:15:00"),
     "Mostró más interés en Conectividad.", 1, "P000000001", 1200.5, "conectividad"),
    (2, "C000000002", "A000000001", "whatsapp", "interesado", ts("2025-01-31 10:00:00"),
     "Pidió catálogo de hogar!!", 1, "P000000002", 300.0, "hogar"),
    (3, "C000000001", "A000000002", "llamada", "no_interesado", ts("2025-02-02 14:30:00"),
     "No desea más llamadas.", 0, "NA", 0.0, "NA"),
    (4, "C000000003", "A000000002", "whatsapp", "no_interesado", ts("2025-02-14 17:05:00"),
     "Dijo que NO utiliza servicios", 0, "NA", 0.0, "NA"),
    (5, "C000000004", "A000000003", "llamada", "interesado", ts("2025-05-15 12:00:00"),
     "Mañana compra 2 equipos", 1, None, None, None),
    (6, None, None, None, None, None, None, 0, None, None, None),
    (7, "C000000005", "A000000003", "whatsapp", "interesado", ts("2025-05-20 21:59:59"),
     "Cliente   ocupado", 0, "P000000009", 99.0, "hogar"),
    (8, "C000000006", "A000000003", "llamada", "no_interesado", ts("2025-11-21 18:00:00"),
     "", 1, "NA", 450.25, "movilidad"),
    (9, "C000000007", "A000000004", "whatsapp", "interesado", ts("2025-11-16 16:00:00"),
     "Señal débil 3G", None, None, None, None),
    (10, "C000000002", "A000000004", "llamada", "interesado", ts("2025-11-03 11:00:00"),
     "Pidió cotización", 1, "P000000010", 34999.0, "conectividad"),
    (11, "C000000008", "A000000001", "llamada", "no_interesado", ts("2025-11-03 09:00:00"),
     "No requiere", 0, "NA", 0.0, "NA"),
    (12, "C000000009", "A000000002", "whatsapp", "interesado", ts("2025-02-28 13:45:00"),
     "Quiere movilidad", 1, "P000000012", 800.0, "movilidad"),
]


@pytest.fixture(scope="session")
def golden(spark):
    return spark.createDataFrame(GOLDEN, S.CONTACT_SCHEMA)
