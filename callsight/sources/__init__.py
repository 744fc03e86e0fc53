"""Sources and sinks: contact files, driver-table adapter, model files."""

from .adapter import labelled_notes, orders_from_events, raw_contacts, table  # noqa: F401
from .contacts import (  # noqa: F401
    cached, checkpoint_dir, inputs_frame, materialize, preview, read_contacts,
    resolve_column, row_limit_sample, write_contacts,
)
from .models import load_model, save_model  # noqa: F401
