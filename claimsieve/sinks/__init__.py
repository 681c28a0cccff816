"""Writers and views."""
