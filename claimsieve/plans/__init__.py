"""The jobs: cleansing, typed core tables, use cases, read-backs and the full run."""
