"""The two marts, the dashboard panels, and the jobs that build them."""
