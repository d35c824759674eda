from staffline.streaming.landing import reconcile_export, start_directory_ingest

__all__ = ["reconcile_export", "start_directory_ingest"]
