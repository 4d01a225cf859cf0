"""Sources: landed raw payloads (JSON) and their normalizers (2.A, 2.C)."""
