"""The models: staging, unified activities, marts, and the jobs that read them."""
