"""Readers: GeoJSON feature files, job manifests, landed-file lists and boundary archives."""
