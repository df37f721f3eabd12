from tidecart.streaming import active_users, ad_clicks, change_capture, log_split, order_wide, run

__all__ = ["active_users", "ad_clicks", "change_capture", "log_split", "order_wide", "run"]
