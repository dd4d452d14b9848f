"""Writers: lake layouts, reports and versioned tables."""
