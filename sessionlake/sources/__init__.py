"""Readers and writers for upload folders, zones and warehouse tables."""
