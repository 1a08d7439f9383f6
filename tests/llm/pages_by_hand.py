"""Pages written by hand, with the lines of their main text: layouts that the labeller's generator does not make."""

PAGES = [
    # a news page: site name in the header, byline, notice, comments in the article's own kind of boxes
    ("""<!DOCTYPE html><html lang="en"><head><title>Ferry | Coast Post</title></head><body>
<header><h1>Coast Post</h1><nav><ul><li><a href="/">Home</a></li><li><a href="/p">Politics</a></li>
<li><a href="/s">Sport</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to make this site better. <a href="/c">Learn more</a></p><button>OK</button></div>
<article><h1>Ferry returns to the northern islands</h1>
<p>After three winters without a regular connection the ferry to the northern islands sails again on Monday.</p>
<p>The harbour master said that the repaired pier can take ships of up to ninety metres, and that the first
crossing is already <em>fully booked</em>.</p><p>Tickets cost as much as before.</p></article>
<section class="comments"><h3>2 comments</h3><div class="comment"><b>Mara</b><p>At last, my parents live there!</p></div>
<div class="comment"><b>Jo</b><p>Let us see how long it lasts this time.</p></div></section>
<aside class="sidebar"><h4>Most read</h4><ul><li><a href="/1">Storm closes road</a></li><li><a href="/2">School reopens</a></li></ul></aside>
<footer><p>Copyright 2021 Coast Post. All rights reserved.</p><a href="/privacy">Privacy</a></footer></body></html>""",
     ["Ferry returns to the northern islands",
      "After three winters without a regular connection the ferry to the northern islands sails again on Monday.",
      "The harbour master said that the repaired pier can take ships of up to ninety metres, and that the first "
      "crossing is already fully booked.", "Tickets cost as much as before."]),
    # comments in <div><p> beside an article in <div><p>
    ("""<html><body><div id="menu"><a href="/a">Start</a> | <a href="/b">Archive</a> | <a href="/c">About</a></div>
<div class="post"><h2>Growing tomatoes on a balcony</h2>
<p>Tomatoes need light, a deep pot and patience. I start the seeds indoors at the end of February.</p>
<p>When the plants have four leaves they move into larger pots, and after the last frost they go outside.</p>
<p>Water them in the morning and never on the leaves.</p></div>
<div class="comments"><p>Great post! Which variety do you grow?</p><p>I tried this last year and it worked well.</p></div>
<div class="footer"><p>Powered by a small blog engine</p></div></body></html>""",
     ["Growing tomatoes on a balcony",
      "Tomatoes need light, a deep pot and patience. I start the seeds indoors at the end of February.",
      "When the plants have four leaves they move into larger pots, and after the last frost they go outside.",
      "Water them in the morning and never on the leaves."]),
    # a table of data inside the article stays whole
    ("""<html><head><title>x</title></head><body><nav><a href="/">Home</a><a href="/rivers">Rivers</a></nav><main>
<h1>Water levels of the lower river</h1><p>The station at the bridge has measured the level since the flood. The
table gives the yearly mean in centimetres.</p>
<table><tr><th>Year</th><th>Mean level</th></tr><tr><td>2018</td><td>212</td></tr><tr><td>2019</td><td>198</td></tr>
<tr><td>2020</td><td>241</td></tr></table><p>The rise in the last year follows from the wet spring.</p></main>
<footer>Imprint | Contact</footer></body></html>""",
     ["Water levels of the lower river",
      "The station at the bridge has measured the level since the flood. The table gives the yearly mean in centimetres.",
      "Year", "Mean level", "2018", "212", "2019", "198", "2020", "241",
      "The rise in the last year follows from the wet spring."]),
    # German, headings and lists inside, share bar, related articles inside the main column
    ("""<html lang="de"><body><div class="topbar"><a href="/">Startseite</a><a href="/abo">Abo</a></div>
<div class="content"><article class="artikel"><h1>Brot backen mit Sauerteig</h1>
<div class="share"><a href="#">Teilen</a><a href="#">Drucken</a></div>
<p>Ein guter Sauerteig braucht nur Mehl, Wasser und Zeit. Wer ihn einmal angesetzt hat, kann ihn jahrelang pflegen.</p>
<h2>Zutaten</h2><ul><li>500 g Roggenmehl</li><li>350 ml Wasser</li><li>10 g Salz</li></ul>
<p>Den Teig &uuml;ber Nacht ruhen lassen und am Morgen bei 230 Grad backen.</p></article>
<div class="related"><h3>Mehr zum Thema</h3><a href="/1">Hefeteig richtig kneten</a><a href="/2">Alte Getreidesorten</a></div></div>
<div class="footer"><a href="/impressum">Impressum</a><a href="/datenschutz">Datenschutz</a></div></body></html>""",
     ["Brot backen mit Sauerteig",
      "Ein guter Sauerteig braucht nur Mehl, Wasser und Zeit. Wer ihn einmal angesetzt hat, kann ihn jahrelang pflegen.",
      "Zutaten", "500 g Roggenmehl", "350 ml Wasser", "10 g Salz",
      "Den Teig über Nacht ruhen lassen und am Morgen bei 230 Grad backen."]),
    # French, no semantic elements, advert between paragraphs, newsletter form
    ("""<html><body><div class="wrapper"><div class="header"><div class="logo">Le Courrier</div><div class="menu">
<ul><li><a href="/">Accueil</a></li><li><a href="/eco">Économie</a></li></ul></div></div>
<div class="main-content"><h1>Le marché couvert rouvre ses portes</h1>
<p>Fermé depuis deux ans pour travaux, le marché couvert accueille de nouveau ses clients à partir de samedi.</p>
<div class="advert"><p>Publicité : -50% sur les vélos</p></div>
<p>Une quarantaine de commerçants ont déjà repris leur place sous la halle rénovée.</p>
<p>La mairie promet un parking gratuit jusqu'à la fin de l'année.</p></div>
<form class="newsletter"><label>Votre adresse</label><input><button>Je m'abonne</button></form>
<div class="footer"><p>Mentions légales</p></div></div></body></html>""",
     ["Le marché couvert rouvre ses portes",
      "Fermé depuis deux ans pour travaux, le marché couvert accueille de nouveau ses clients à partir de samedi.",
      "Une quarantaine de commerçants ont déjà repris leur place sous la halle rénovée.",
      "La mairie promet un parking gratuit jusqu'à la fin de l'année."]),
    # an article of one paragraph with a header inside it
    ("""<html><body><header class="site-header"><h1>Hill Observatory</h1><p>Looking up since 1911</p></header>
<nav class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">Notes</a></nav>
<article><header><h1>A comet in the evening sky</h1></header>
<p>The comet stands low in the west after sunset and can be seen with field glasses until the end of the month.</p></article>
<footer><p>Terms of use</p><p>Contact us</p></footer></body></html>""",
     ["A comet in the evening sky",
      "The comet stands low in the west after sunset and can be seen with field glasses until the end of the month."]),
    # a quotation and code, sign-up box at the end of the article
    ("""<html><body><div class="nav"><ul><li><a href="/">Blog</a></li><li><a href="/t">Tags</a></li></ul></div>
<main><article><h1>Why I write tests first</h1><p>A test that was never red proves little. So I begin with the failing one.</p>
<blockquote>Make it fail, make it pass, make it clean.</blockquote><pre>assert add(1, 2) == 3</pre>
<p>Only then do I touch the code.</p><div class="newsletter"><p>Subscribe to our newsletter</p>
<form><input><button>Sign up</button></form></div></article></main>
<div id="disqus" class="comments"><h3>Leave a comment</h3><form><textarea></textarea><button>Send</button></form></div>
</body></html>""",
     ["Why I write tests first", "A test that was never red proves little. So I begin with the failing one.",
      "Make it fail, make it pass, make it clean.", "assert add(1, 2) == 3", "Only then do I touch the code."]),
    # Spanish, table layout, old style
    ("""<html><body><table><tr><td class="menu"><a href="1">Inicio</a><br><a href="2">Noticias</a><br><a href="3">Contacto</a></td>
<td class="content"><h1>La biblioteca amplía su horario</h1><p>Desde el lunes la biblioteca del barrio abre también por la
noche, hasta las once.</p><p>Los vecinos lo pedían desde hace años, sobre todo los estudiantes.</p></td>
<td class="sidebar"><p>Lo más leído</p><a href="4">Obras en la plaza</a></td></tr></table>
<p class="footer">Todos los derechos reservados</p></body></html>""",
     ["La biblioteca amplía su horario",
      "Desde el lunes la biblioteca del barrio abre también por la noche, hasta las once.",
      "Los vecinos lo pedían desde hace años, sobre todo los estudiantes."]),
    # no class or id anywhere: comments in the same kind of boxes as the article, site name in the header
    ("""<html><body><header><h1>The Garden Diary</h1></header><div><a href="/">Home</a><a href="/all">All notes</a></div>
<div><h1>Pruning an old apple tree</h1><p>An old apple tree should lose no more than a third of its wood in one winter.</p>
<p>Begin with the dead branches, then open the crown so that light reaches the middle.</p>
<p>Cut on a dry day, and leave the collar of the branch alone.</p></div>
<div><h3>Comments (2)</h3><p>Thanks for sharing. Our tree is forty years old and still bears fruit.</p>
<p>I agree. The collar is what most people get wrong.</p></div>
<footer>Copyright 2019</footer></body></html>""",
     ["Pruning an old apple tree", "An old apple tree should lose no more than a third of its wood in one winter.",
      "Begin with the dead branches, then open the crown so that light reaches the middle.",
      "Cut on a dry day, and leave the collar of the branch alone."]),
    # a table of prices between paragraphs, a notice above, site name in the header
    ("""<html><body><div class="alert"><p>You have read your last free article.</p></div><header><h1>Harbour News</h1>
<p>Search</p></header><div class="story"><h1>What a crossing costs</h1><p>The company has published its new fares,
which hold from May on.</p><table><tr><td>Adults</td><td>12.5</td><td>2020</td></tr><tr><td>Children</td><td>6</td><td>2021</td>
</tr></table><p>Bicycles travel free of charge.</p></div><aside><p>Advertisement</p><p>Order today and save!</p></aside>
</body></html>""",
     ["What a crossing costs", "The company has published its new fares, which hold from May on.", "Adults", "12.5", "2020",
      "Children", "6", "2021", "Bicycles travel free of charge."]),
]
