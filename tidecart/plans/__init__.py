from tidecart.plans import active_users, ad_clicks, change_capture, dimensions, log_split, order_wide, serving

__all__ = ["active_users", "ad_clicks", "change_capture", "dimensions", "log_split", "order_wide", "serving"]
