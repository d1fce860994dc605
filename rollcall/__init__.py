"""Event participant analytics on Spark DataFrames.

Lists event editions, extracts paid and non-cancelled participants and their
form answers, numbers rows in global batches, normalises and profiles postal
codes, resolves them to addresses from landed provider responses and joins
everything into one participant report.  Every public function takes and
returns DataFrames, so it composes with ``DataFrame.transform``.
"""

from rollcall.session import build_session, ensure_checkpoint_dir, materialize, scale_conf

__all__ = [
    "build_session", "ensure_checkpoint_dir", "materialize", "scale_conf",
    "list_editions", "extract_forms", "extract_participants", "number_batches", "select_batch",
    "normalise_postal_codes", "profile_postal_codes", "lookup_provider", "resolve_addresses",
    "join_addresses", "build_report",
]


def __getattr__(name):
    # Lazy re-exports, so ``import rollcall`` stays light.
    from importlib import import_module
    homes = {
        "list_editions": "rollcall.operators.catalogue",
        "extract_forms": "rollcall.plans.extract",
        "extract_participants": "rollcall.plans.extract",
        "number_batches": "rollcall.operators.batching",
        "select_batch": "rollcall.operators.batching",
        "normalise_postal_codes": "rollcall.operators.postal",
        "profile_postal_codes": "rollcall.operators.postal",
        "lookup_provider": "rollcall.operators.lookup",
        "resolve_addresses": "rollcall.operators.lookup",
        "join_addresses": "rollcall.operators.report",
        "build_report": "rollcall.plans.report",
    }
    if name in homes:
        return getattr(import_module(homes[name]), name)
    raise AttributeError(name)
